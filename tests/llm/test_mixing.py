from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from stockweave.llm import mixing
from tests.llm import tables


def size_of(text):
    return len((text or "").encode().split())


def targets_by_hand(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight; what is above a limit stops there and the rest is shared anew."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    full, total = {}, sum(sizes.values())
    while True:
        free = [n for n in names if n not in full]
        level = (total - sum(full.values())) / sum(weight[n] for n in free) if free else 0
        over = [n for n in free if level * weight[n] > most * sizes[n]]
        if not over:
            return full | {n: level * weight[n] for n in free}
        full |= {n: most * sizes[n] for n in over}


def check(rows, found):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += size_of(text)
    expected = targets_by_hand(dict(sizes))
    taken, largest = defaultdict(int), defaultdict(int)
    for row in found:
        assert row.source_size == sizes[row.source]
        assert row.target == pytest.approx(expected[row.source])
        assert 0 <= row.taken <= 3 * row.size and (row.size == 0 or row.taken % row.size == 0)
        taken[row.source] += row.taken
        largest[row.source] = max(largest[row.source], row.size)
    assert Counter((r.doc_id, r.size) for r in found) == Counter((i, size_of(t)) for i, t, _ in rows)
    return taken, expected, largest


def test_sources_come_near_their_targets(spark):
    generator = random.Random(5)
    rows = [(i, tables.sentence(generator, generator.randint(1, 90)), generator.choice(["hot"] * 4 + list("abcdefg") + [None]))
            for i in range(2_000)]
    found = mixing.mix(tables.documents(spark, rows)).collect()
    taken, expected, largest = check(rows, found)
    for source, target in expected.items():
        assert abs(taken[source] - target) <= 2 * largest[source]
    assert sum(taken.values()) == pytest.approx(sum(size_of(t) for _, t, _ in rows), rel=0.01)


def test_odd_rows_and_reruns(spark):
    rows = tables.odd_rows()
    table = tables.with_clashes(tables.documents(spark, rows))
    first = mixing.mix(table).collect()
    check(rows, first)
    assert Counter(map(tuple, mixing.mix(table.repartition(5)).collect())) == Counter(map(tuple, first))


def test_full_sources_pass_their_excess_on(spark):
    sized = spark.createDataFrame([("a", 1), ("b", 10), ("c", 1000), ("d", 0), (None, 40)], "source string, size long")
    found = {r.source: r.target for r in mixing.targets(sized).collect()}
    assert found == pytest.approx(targets_by_hand({"a": 1, "b": 10, "c": 1000, "d": 0, None: 40}))
    assert found["a"] == 3


def test_the_documents_of_the_mix_are_repeated_as_often_as_taken(spark):
    rows = [(i, "w " * (i % 7 + 1), "abc"[i % 3]) for i in range(200)]
    table = tables.with_clashes(tables.documents(spark, rows))
    plan = {r.doc_id: r.taken // r.size for r in mixing.mix(table).collect()}
    made = mixing.mixed_documents(table)
    assert made.columns == table.columns
    assert Counter(r.doc_id for r in made.collect()) == Counter({i: n for i, n in plan.items() if n})


def words_by_text(rows):
    return Counter(row.text for row in rows)


@pytest.mark.parametrize("ids", [lambda i: None, lambda i: 7, lambda i: i % 3])
def test_rows_that_share_an_id_are_mixed_as_planned(spark, ids):
    """Unlike rows without id or with the same one, of equal sizes, beside another source."""
    generator = random.Random(11)
    rows = [(ids(i), tables.sentence(generator, 10), "a") for i in range(200)]
    rows += [(10_000 + i, tables.sentence(generator, 10), "b") for i in range(100)]
    table = tables.with_clashes(tables.documents(spark, rows)).repartition(5)
    plan = mixing.mix(table).collect()
    taken, expected, largest = check(rows, plan)
    made = mixing.mixed_documents(table).collect()
    words = defaultdict(int)
    for row in made:
        words[row.source] += size_of(row.text)
    assert words == {source: n for source, n in taken.items() if n}
    assert all(abs(taken[s] - expected[s]) <= 2 * largest[s] for s in expected)
    assert max(words_by_text(made).values()) <= 3
    assert words_by_text(made) == words_by_text(mixing.mixed_documents(table.repartition(3)).collect())


def test_repeated_rows_share_their_copies(spark):
    """Rows alike in id, source and text, which differ in another column."""
    text = "one two three"
    rows = [(1, text, f"l{i}", "a", None) for i in range(90)] + [(i, f"{text} {i}", "x", "b", None) for i in range(40)]
    table = spark.createDataFrame(rows, tables.SCHEMA).repartition(4)
    plan = sum(r.taken // r.size for r in mixing.mix(table).collect() if r.doc_id == 1 and r.source == "a")
    made = Counter(r.lang for r in mixing.mixed_documents(table).collect() if r.source == "a")
    assert sum(made.values()) == plan > 90
    assert max(made.values()) - min(made.values()) <= 1 and len(made) == 90


def test_empty_and_wordless_tables(spark):
    assert mixing.mix(tables.documents(spark, [])).count() == 0
    assert mixing.mixed_documents(tables.documents(spark, [])).count() == 0
    blank = mixing.mix(tables.documents(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 2
