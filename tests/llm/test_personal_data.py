from __future__ import annotations

import random
import re
import time
from collections import defaultdict
from hashlib import sha256
from math import prod, sqrt

import pytest

from stockweave.llm import personal_data
from tests.llm import tables

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(map(int, str(2 * int(x)))) for x in even)) % 10 == 0


def slow_base(text):
    """The spans by the patterns as they are given."""
    found = []
    for number, (kind, pattern) in enumerate(PLAIN.items()):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            good = {
                "email": True, "ip": all(int(x) <= 255 for x in match[0].split(".")) if kind == "ip" else True,
                "card": 16 <= len(digits) <= 19 and luhn(digits) if kind == "card" else True, "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((number, *match.span()))
    return found


def card(generator, length=16):
    digits = "".join(generator.choices("0123456789", k=length - 1))
    return next(digits + x for x in "0123456789" if luhn(digits + x))


def noise(generator):
    parts = ["@", ".", "+", "-", " ", "a", "b.c", "1", "25", "256", "10.0.0.1", "1.2.3", "x@y.z", "a@b", "@@", "+49", "(30)", "4111 1111 1111 1111", "\n", "é", "0000012"]
    return "".join(generator.choice(parts) for _ in range(generator.randint(1, 40)))


def test_base_spans_match_the_given_patterns():
    generator = random.Random(5)
    texts = [noise(generator) for _ in range(4_000)]
    texts += [f"pay {card(generator, n)} or {'-'.join(re.findall('....', card(generator)))} now" for n in range(14, 22)]
    for text in texts:
        assert personal_data.base_spans(text) == slow_base(text), text


def test_long_runs_take_linear_time():
    start = time.perf_counter()
    for part in ("a", "1", "1.", "+", "@", "a@", "1 ", "+1", "a-", "at ", "x at y dot ", "1:", "+1-", "(1) ", "1a", "é1"):
        text = part * (400_000 // len(part))
        personal_data.mentions(text, personal_data.base_spans(text))
    assert time.perf_counter() - start < 60


def test_contexts_are_whole_tokens():
    text = f"{'x' * 500} call: 5551234567 {'Y' * 300}"
    at = text.index("555")
    assert personal_data.contexts(text, at, at + 10) == ["call : <>", f": <> {'y' * 300}"]
    assert personal_data.contexts("12", 0, 2) == ["  <>", " <> "]


def slow_added(texts, trust, rounds):
    """Scores over dictionaries, spans by every text."""
    graph, seeds, fits = defaultdict(set), defaultdict(set), defaultdict(set)
    mentioned = [personal_data.mentions(t, slow_base(t)) for t in texts]
    for found in mentioned:
        for instance, seed, fit, _, _, patterns in found:
            for pattern in patterns:
                graph[pattern].add(instance)
            seeds[instance] |= {k for k in range(4) if seed >> k & 1}
            fits[instance] |= {k for k in range(4) if fit >> k & 1}
    scores = {(i, k): 1.0 for i in seeds for k in seeds[i]}
    fixed, discovered = dict(scores), {}
    for _ in range(rounds):
        trusted = {}
        for pattern, members in graph.items():
            for k in range(4):
                n, hits = len(members), sum(scores.get((i, k), 0) for i in members)
                share, z = hits / n, 1.96
                low = (share + z * z / (2 * n) - z * sqrt(max(0, share * (1 - share) / n + z * z / (4 * n * n)))) / (1 + z * z / n)
                if hits and low >= trust:
                    trusted[pattern, k] = low
        discovered = {}
        for i in seeds:
            for k in fits[i] if not seeds[i] else ():
                low = [c for (p, kind), c in trusted.items() if kind == k and i in graph[p]]
                if low:
                    discovered[i, k] = 1 - prod(1 - c for c in low)
        scores = fixed | discovered
    best = {}
    for (i, k), score in discovered.items():
        if i not in best or (score, -k) > (best[i][1], -best[i][0]):
            best[i] = (k, score)
    return [
        sorted((best[i][0], s, e) for i, seed, fit, s, e, _ in found if not seed and i in best and fit >> best[i][0] & 1)
        for found in mentioned
    ]


def corpus(seed=3):
    generator = random.Random(seed)
    texts, words = [], tables.WORDS
    say = lambda n: " ".join(generator.choices(words, k=n))
    for i in range(60):
        number = f"+1 ({generator.randint(200, 999)}) 555-{generator.randint(1000, 9999)}"
        texts.append(f"{say(5)} please call: {number} today {say(3)}")
        texts.append(f"{say(4)} write to mail <{generator.choice(words)}.{i}@mail.example.com> or not")
        texts.append(f"{say(3)} order number {generator.randint(10**9, 10**10)} {say(4)}")
        texts.append(f"{say(3)} host is 10.{i}.3.{i} up {say(2)}")
    texts += [
        "so please call: 0171 555 1234 today", "or phone (0171) 555-1234 maybe", "write to mail <jane(at)corp(dot)example> or not",
        "my host is fe80::1:2 up", "order number 0171 555 9999", "nothing here", "ring me under 0171 555 1234.",
    ]
    return texts


def names(spans):
    return ",".join(f"{personal_data.KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def test_patterns_discover_what_stands_in_their_contexts(spark):
    texts = corpus()
    rows = [(i, text, "s") for i, text in enumerate(texts)]
    found = {r.doc_id: r for r in personal_data.find_personal_data(tables.documents(spark, rows)).collect()}
    added = {i: {texts[i][s.start : s.end] for s in r.added} for i, r in found.items() if r.added}
    last = len(texts)
    assert added == {
        last - 7: {"0171 555 1234"}, last - 6: {"0171) 555-1234"}, last - 5: {"jane(at)corp(dot)example"},
        last - 4: {"fe80::1:2"}, last - 1: {"0171 555 1234"},
    }
    patterns = {(r.pattern, r.kind) for r in personal_data.trusted_patterns(tables.documents(spark, rows)).collect()}
    assert {("call : <>", "phone"), (": <> today", "phone"), ("mail < <>", "email"), ("host is <>", "ip")} <= patterns
    assert not any(pattern.startswith("order") for pattern, _ in patterns)


@pytest.mark.parametrize("trust", [0.2, 0.5, personal_data.TRUST])
def test_result_matches_brute_force(spark, tmp_path, trust):
    generator = random.Random(8)
    texts = corpus() + [noise(generator) for _ in range(300)]
    rows = tables.odd_rows() + [(i, text, "s") for i, text in enumerate(texts, 10_000)] + [(i, texts[-1], None) for i in (1, 2, 2, None)]
    table = tables.with_clashes(tables.documents(spark, rows)).repartition(4)
    found = personal_data.find_personal_data(table, trust=trust)
    plain = [text or "" for _, text, _ in rows]
    added = slow_added(plain, trust, personal_data.ROUNDS)
    as_rows = [(r.doc_id, [tuple(x) for x in r.base], [tuple(x) for x in r.added]) for r in found.collect()]
    assert sorted(as_rows, key=str) == sorted(((i, slow_base(t), more) for (i, _, _), t, more in zip(rows, plain, added)), key=str)
    if trust == personal_data.TRUST:
        table.write.parquet(f"{tmp_path}/documents.parquet")
        rows_out = personal_data.op12_personal_data(spark, str(tmp_path)).collect()
        expected = []
        for (i, _, _), text, more in zip(rows, plain, added):
            base = slow_base(text)
            expected.append((
                i, *[sum(k == kind for k, _, _ in base) for kind in range(4)],
                sha256(names(base).encode()).hexdigest(), names(base + more), len(more),
            ))
        assert sorted(map(tuple, rows_out), key=str) == sorted(expected, key=str)


def test_copies_of_one_seed_do_not_make_a_pattern(spark):
    rows = [(i, "please call: +1 (743) 555-3824 today", "s") for i in range(200)] + [(300, "please call: 0171 555 1234 today", "s")]
    found = personal_data.find_personal_data(tables.documents(spark, rows)).collect()
    assert not any(r.added for r in found)


def test_an_empty_table_gives_an_empty_one(spark):
    assert personal_data.find_personal_data(tables.documents(spark, [])).count() == 0
    assert personal_data.trusted_patterns(tables.documents(spark, [])).count() == 0
