from __future__ import annotations

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockweave.llm import exact_dedup
from stockweave.llm.fuse_filter import FuseFilter
from tests.llm import tables


def lowered(text):
    return (text or "").encode().lower().decode()


def by_hand(rows):
    groups = {}
    for doc_id, text, _ in rows:
        groups.setdefault(lowered(text), []).append(doc_id)
    made = Counter()
    for doc_id, text, _ in rows:
        group = groups[lowered(text)]
        keep = max((i for i in group if i is not None), default=None)
        made[doc_id, keep, len(group), doc_id == keep, sha256(lowered(text).encode()).hexdigest()] += 1
    return made


def test_rows_match_brute_force(spark):
    rows = tables.odd_rows()
    found = exact_dedup.dedup(tables.with_clashes(tables.documents(spark, rows)))
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, found.collect())) == by_hand(rows)


@pytest.mark.parametrize("in_snapshot", ["true", "false", "doc_id % 3 = 0"])
def test_any_split_gives_the_same_groups(spark, in_snapshot):
    rows = tables.odd_rows(2)
    found = exact_dedup.dedup(tables.documents(spark, rows), in_snapshot=F.coalesce(F.expr(in_snapshot), F.lit(False)))
    assert Counter(map(tuple, found.collect())) == by_hand(rows)


def test_colliding_digests_are_told_apart_by_bytes(spark):
    rows = tables.odd_rows(3)
    weak = lambda text: F.lpad(F.hex(F.crc32(text) % 3), 32, "0")
    found = exact_dedup.dedup(tables.documents(spark, rows), digest=weak)
    assert Counter(tuple(r)[:4] for r in found.collect()) == Counter(key[:4] for key in by_hand(rows).elements())


def test_kept_documents_are_whole_rows_and_one_for_each_text(spark):
    rows = tables.odd_rows()
    table = tables.with_clashes(tables.documents(spark, rows))
    kept = exact_dedup.kept_documents(table)
    assert kept.columns == table.columns
    texts = Counter(lowered(r.text) for r in kept.collect())
    assert texts == Counter({lowered(text): 1 for _, text, _ in rows})


def test_an_empty_table_gives_an_empty_one(spark):
    empty = tables.documents(spark, [])
    assert exact_dedup.dedup(empty).count() == 0
    assert exact_dedup.kept_documents(empty).count() == 0


@pytest.mark.parametrize("size", [0, 1, 2, 3, 10, 100, 5_000, 100_000])
def test_filters_know_all_their_keys_and_few_others(size):
    generator = np.random.default_rng(size)
    keys = generator.integers(0, 1 << 64, size, dtype=np.uint64)
    made = FuseFilter.build(keys)
    assert made.contains(keys).all()
    others = generator.integers(0, 1 << 64, 100_000, dtype=np.uint64)
    assert made.contains(others).mean() < 0.006
    if size >= 5_000:
        assert len(made.table) < 1.3 * size + 200


def test_screen_turns_away_no_digest_of_the_snapshot(spark):
    generator = random.Random(4)
    digest = lambda i: sha256(str(i).encode()).hexdigest()
    old = spark.createDataFrame([(i, digest(i)) for i in range(2_000)], "doc_id long, digest string")
    numbers = [generator.randrange(4_000) for _ in range(500)]
    new = spark.createDataFrame([(digest(i), i, 1) for i in set(numbers)], "digest string, last_id long, n long")
    screened = exact_dedup.screen(new, exact_dedup.build_snapshot(old)).collect()
    assert len(screened) == len(set(numbers))
    assert all(row.maybe for row in screened if row.last_id < 2_000)
    assert sum(row.maybe for row in screened if row.last_id >= 2_000) < 15
