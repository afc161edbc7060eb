from __future__ import annotations

import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from stockweave.llm import pitman_yor
from tests.llm import tables


def tokens(text):
    return (text or "").encode().lower().split() + [pitman_yor.END]


def is_held_out(doc_id):
    return crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def markov(seed: int, n: int):
    """Texts in which a word says much about the next one."""
    generator = random.Random(seed)
    follow = {w: generator.sample(tables.WORDS, 3) for w in tables.WORDS}
    rows = []
    for i in range(n):
        words = [generator.choice(tables.WORDS)]
        for _ in range(generator.randint(5, 60)):
            words.append(generator.choice(follow[words[-1]]) if generator.random() < 0.9 else generator.choice(tables.WORDS))
        rows.append((i, " ".join(words), "s"))
    return rows


def check_counts(rows, found):
    counts = Counter(w for i, t, _ in rows if not is_held_out(i) for w in tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    expected = sorted(
        (str(i), is_held_out(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)),
         round(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in tokens(t)), 6)) for i, t, _ in rows
    )
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in found) == expected
    assert all(r.train_tokens == total for r in found)


@pytest.mark.parametrize("block_tokens", [1 << 21, 200])
def test_counts_match_brute_force(spark, monkeypatch, block_tokens):
    monkeypatch.setattr(pitman_yor.count_blocks, "__defaults__", (block_tokens,))
    monkeypatch.setattr(pitman_yor, "BUCKET_BYTES", 5_000)
    rows = tables.odd_rows()
    found = pitman_yor.score(tables.with_clashes(tables.documents(spark, rows))).collect()
    check_counts(rows, found)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in found)


def test_blocks_that_are_alike_are_told_apart(spark):
    """A table put together with itself, and one repeated row in every partition."""
    rows = [(i, text, source) for i, text, source in tables.odd_rows() if i is None or i < 250] + [(400, None, "s"), (401, " ", "s")]
    for made in (rows, [(400, None, "s")]):
        once = tables.documents(spark, made)
        twice = once.union(once)
        assert twice.rdd.getNumPartitions() == 2 * once.rdd.getNumPartitions()
        check_counts(made * 2, pitman_yor.score(twice).collect())


def test_held_out_texts_are_likelier_than_by_single_words(spark):
    rows = markov(1, 1_500)
    scored = pitman_yor.score(tables.documents(spark, rows)).cache()
    found = scored.collect()
    check_counts(rows, found)
    held = [r for r in found if r.held_out]
    base = 10 ** (-sum(r.base_score for r in held) / sum(r.n_tokens for r in held))
    assert pitman_yor.perplexity(scored) < 0.6 * base
    again = {r.doc_id: r.score for r in pitman_yor.score(tables.documents(spark, rows)).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score, abs=1e-6) for r in found)


def test_every_word_before_is_a_context_of_its_own(spark, monkeypatch):
    """2,000 words, each followed by one other: more than any fixed number of classes can tell apart."""
    monkeypatch.setattr(pitman_yor, "BUCKET_BYTES", 20_000)
    generator = random.Random(3)
    rows = [(i, " ".join(f"a{k} b{k}" for k in generator.choices(range(2_000), k=40)), "s") for i in range(1_500)]
    scored = pitman_yor.score(tables.documents(spark, rows)).cache()
    check_counts(rows, scored.collect())
    # the first word of a pair is one of 2,000, the second is certain
    assert pitman_yor.perplexity(scored) < 1.5 * math.sqrt(2_000)


def test_probabilities_of_a_context_add_up_to_one():
    """Over all training words and the unknown one, in every context and for every recorded round."""
    generator = np.random.default_rng(2)
    words, contexts = 30, pitman_yor.CONTEXTS + 1
    dense = generator.poisson(0.03, (words, contexts)) * generator.integers(1, 40, (words, contexts))
    dense[:, 0] += 1
    owner, context = np.nonzero(dense)
    cells = pitman_yor.Cells(np.arange(words, dtype=np.uint64), owner, context, dense[owner, context].astype(np.int64))
    totals = pitman_yor.Totals(words, int(dense.sum()), dense.sum(axis=0).astype(float), 0.6, 0.7)
    state = None
    for done in range(4):
        state = pitman_yor.sweep(cells, totals, 0, state) if done else pitman_yor.start(cells)
        state = pitman_yor.State.unpacked(state.packed())
        tables_, customers, parent_tables = state.tables, state.customers(cells), state.parent_tables
        assert (tables_ >= 1).all() and (tables_ <= cells.counts).all() and (tables_[cells.counts == 1] == 1).all()
        assert (parent_tables >= 1).all() and (parent_tables <= customers).all()
        totals.rounds.append((np.bincount(context, tables_, minlength=contexts).astype(float), int(customers.sum()), int(parent_tables.sum())))
        parent = totals.parent(done, customers, parent_tables)
        unknown = totals.parent(done, np.zeros(1), np.zeros(1))[0]
        assert parent.sum() + unknown == pytest.approx(1)
        open_ = totals.openness(done)
        for u in range(contexts):
            here = context == u
            own = (cells.counts[here] - totals.discount * tables_[here]) / (pitman_yor.STRENGTH + totals.customers[u])
            assert own.sum() + open_[u] == pytest.approx(1)


def test_reseating_has_the_right_distribution():
    """Gibbs steps leave the exact distribution of the number of tables, known for three customers."""
    discount, opening, n = 0.5, 0.8, 40_000
    rng = np.random.default_rng(4)
    # ways to seat three customers at 1, 2, 3 tables, each new table with weight `opening`
    weights = np.array([(1 - discount) * (2 - discount) * opening, 3 * (1 - discount) * opening**2, opening**3])
    customers, tables_ = np.full(n, 3), np.ones(n, dtype=np.int64)
    for _ in range(15):
        tables_ = pitman_yor.reseat(customers, tables_, np.full(n, opening), discount, rng)
    found = np.bincount(tables_, minlength=4)[1:] / n
    assert found == pytest.approx(weights / weights.sum(), abs=0.01)


def exact_mean(customers, opening, discount):
    """The mean number of tables of a dish, by its recursion over customers."""
    chance = np.zeros(3_001)
    chance[1] = 1.0
    for n in range(1, customers):
        chance = chance * (n - discount * np.arange(3_001)).clip(0) + opening * np.append(0, chance[:-1])
        chance /= chance.sum()
    return chance @ np.arange(3_001), chance


@pytest.mark.parametrize("customers, opening", [(400, 3.0), (1_900, 400.0), (3_000, 0.8), (9_000, 0.1), (6_000, 40.0), (9_000, 300.0)])
def test_all_customers_of_a_large_dish_are_reseated(customers, opening):
    """From the start with one table, a few sweeps give the exact distribution of the number of tables."""
    discount, n = 0.6, 150
    rng, seats = np.random.default_rng(6), {}
    mean, chance = exact_mean(customers, opening, discount)
    deviation = math.sqrt(chance @ (np.arange(3_001) - mean) ** 2)
    tables_, found = np.ones(n, dtype=np.int64), []
    for sweep in range(12):
        tables_ = pitman_yor.reseat(np.full(n, customers), tables_, np.full(n, opening), discount, rng, seats)
        if sweep >= 4:
            found.append(tables_)
    assert np.mean(found) == pytest.approx(mean, abs=0.25 * deviation)
    assert np.std(found) == pytest.approx(deviation, rel=0.15)


@pytest.mark.parametrize("discount, customers, opening, variation, off", [
    (0.1, 3_000, 0.8, 0.001, 0.001), (0.1, 30_000, 5.0, 0.001, 0.001), (0.1, 6_000, 40.0, 0.01, 0.01), (0.6, 6_000, 40.0, 0.001, 0.001),
    (0.95, 9_000, 0.1, 0.001, 0.001), (0.1, 6_000, 500.0, 1.0, 0.04), (0.6, 6_000, 500.0, 0.01, 0.001),
])
def test_the_stated_error_of_a_large_dish(discount, customers, opening, variation, off):
    """The distribution that a draw has, worked out, against the recursion over all customers."""
    mean, chance = exact_mean(customers, opening, discount)
    first = max(pitman_yor.EXACT, math.ceil(pitman_yor.DENSE * opening))
    thinned = (first / customers) ** discount
    begun = pitman_yor._seatings(discount)[first, 1 : first + 1] + math.log(opening * thinned) * np.arange(1, first + 1)
    begun = np.append(0, np.exp(begun - begun.max()))
    more, tables_ = opening / discount * (1 - thinned), np.arange(3_001)
    poisson = np.exp(tables_ * math.log(more) - more - np.array([math.lgamma(k + 1) for k in tables_]))
    drawn = np.convolve(begun / begun.sum(), poisson)[:3_001]
    assert np.abs(drawn - chance).sum() / 2 < variation
    assert drawn @ tables_ == pytest.approx(mean, rel=off)


def test_a_sweep_in_groups_keeps_the_exact_distribution():
    """What dishes with very many tables rely on; also when customers come and go between sweeps."""
    discount, opening, rng, sizes, found = 0.6, 9.0, np.random.default_rng(8), np.array([60]), []
    mean, chance = exact_mean(60, opening, discount)
    for sweep in range(4_000):
        sizes = pitman_yor._sweep(sizes, opening, discount, rng)
        assert sizes.sum() == 60 and (sizes > 0).all()
        found.append(len(sizes))
    assert np.mean(found[100:]) == pytest.approx(mean, abs=0.25)
    assert np.std(found[100:]) == pytest.approx(math.sqrt(chance @ (np.arange(3_001) - mean) ** 2), rel=0.1)
    for customers in (20, 300, 1):
        sizes = pitman_yor._fill(sizes, customers, opening, discount, rng)
        assert sizes.sum() == customers and (sizes > 0).all()


def test_packing_is_exact():
    generator = np.random.default_rng(5)
    for kind in (np.uint8, np.uint16, np.uint32, np.int64, np.uint64, np.float32):
        for size in (0, 1, 1_000):
            values = generator.integers(0, 200, size).astype(kind)
            assert (pitman_yor.unpack(pitman_yor.pack(values), kind) == values).all()


def test_rising_numbers_are_packed_by_steps():
    generator = np.random.default_rng(7)
    sizes = np.array([0, 3, 0, 1, 500, 0])
    groups = [np.sort(generator.choice(1 << 62, n, replace=False)) for n in sizes]
    numbers = np.concatenate(groups).astype(np.uint64)
    assert (pitman_yor._unpack_rising(pitman_yor._pack_rising(numbers, sizes), sizes) == numbers).all()
    assert (pitman_yor._unpack_rising(pitman_yor._pack_rising(groups[4])) == groups[4]).all()
    nothing = np.zeros(0, dtype=np.uint64)
    assert not len(pitman_yor._unpack_rising(pitman_yor._pack_rising(nothing)))
    assert not len(pitman_yor._unpack_rising(pitman_yor._pack_rising(nothing, sizes[:1]), sizes[:1]))
    for seats in ({}, {5: np.array([3, 1])}, {5: np.array([3, 1]), 2: np.array([7])}):
        again = pitman_yor._unpack_seats(pitman_yor._pack_seats(seats))
        assert {k: v.tolist() for k, v in again.items()} == {k: v.tolist() for k, v in seats.items()}


def test_empty_tables_and_tables_without_training_texts(spark):
    assert pitman_yor.score(tables.documents(spark, [])).count() == 0
    held = next(i for i in range(100) if is_held_out(i))
    found = pitman_yor.score(tables.documents(spark, [(held, "only this", "s")])).collect()
    check_counts([(held, "only this", "s")], found)
    assert found[0].n_known == 0 and found[0].train_tokens == 0
