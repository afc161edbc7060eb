from __future__ import annotations

import random

from pyspark.sql import functions as F

from sequential import fold, long_form
from stockweave.operators import reconcile as r
from stockweave.schemas import FEED

GOLDEN = [
    (1, 1, "Brush A", "S1", "Samyan", 4.0),
    (1, 2, "Brush B", "S1", "Samyan", 7.0),
    (1, 3, "Floss", "S2", "Samyan", 0.0),
    (1, 4, "S9", "S3", "Samyan", 2.0),
    (1, 5, "Brush B", "S1", "Circle", 5.0),
    (1, 6, "Brush A", "S1", "Circle", 9.0),
    (1, 7, "Floss", "S2x", "Circle", 3.0),
    (1, 8, "Floss", "S2", "Circle", 6.0),
    (2, 9, None, "S1", "On Time", 12.0),
    (2, 10, None, "S7", "On Time", 1.0),
    (2, 11, None, "S7", "On Time", 8.0),
    (2, 12, None, "S9", "On Time", 50.0),
    (3, 13, None, "S2", "T One Building", 2.0),
    (3, 14, None, "S8", "True Digital Park", 5.0),
    (4, 15, "Floss", "S5", "HQ", 10.0),
    (4, 16, "Gum", "S7", "HQ", 20.0),
    (5, 17, "Gum", "S6", "Saimai", -1.0),
    (5, 18, "New", "S1", "Samyan", 1.0),
]
GOLDEN_SNAPSHOT = [
    ("S1", "Brush A", "Circle", 5.0, 1),
    ("S1", "Brush A", "On Time", 12.0, 1),
    ("S1", "Brush A", "Samyan", 1.0, 1),
    ("S2", "Floss", "Circle", 6.0, 3),
    ("S2", "Floss", "HQ", 10.0, 3),
    ("S2", "Floss", "Samyan", 0.0, 3),
    ("S2", "Floss", "T One Building", 2.0, 3),
    ("S3", "S9", "Samyan", 2.0, 4),
    ("S7", "S7", "HQ", 20.0, 10),
    ("S7", "S7", "On Time", 8.0, 10),
    ("S7", "S7", "Saimai", -1.0, 10),
    ("S8", "S8", "True Digital Park", 5.0, 14),
]


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def test_golden_case(spark):
    done = r.reconcile(spark.createDataFrame(GOLDEN, FEED))
    assert rows(done.snapshot()) == GOLDEN_SNAPSHOT
    assert [row.ord for row in done.dropped().collect()] == [12]
    assert long_form(fold(GOLDEN)[0]) == GOLDEN_SNAPSHOT


def random_case(case: int, rng: random.Random):
    """A small feed whose names and SKUs often meet; the keys of a case are its own."""
    records = []
    names = [f"{case}:{letter}" for letter in "abcdef"]
    phases = sorted(rng.choice((1, 1, 2, 3, 4, 5)) for _ in range(rng.randint(1, 25)))
    for n, phase in enumerate(phases):
        item = None if phase in (2, 3) else rng.choice(names)
        branch = rng.choice(("X", "Y", "Z"))
        ord_ = case * 100 + n
        records.append((phase, ord_, item, rng.choice(names), branch, float(rng.randint(-3, 30))))
    return records


def check_cases(spark, cases):
    """Cases with keys of their own do not touch each other, so one feed holds them all."""
    records = [record for case in cases for record in case]
    random.Random(1).shuffle(records)
    done = r.reconcile(spark.createDataFrame(records, FEED).repartition(5))
    expected, dropped = [], []
    for case in cases:
        merged, lost = fold(case)
        expected += long_form(merged)
        dropped += lost
    assert rows(done.snapshot()) == sorted(expected)
    assert sorted(row.ord for row in done.dropped().collect()) == sorted(dropped)
    assert dropped
    return done


def test_random_cases(spark):
    rng = random.Random(7)
    check_cases(spark, [random_case(case, rng) for case in range(1500)])


def test_random_cases_without_broadcast(spark):
    """The same through shuffled joins, as for tables too large to broadcast."""
    rng = random.Random(8)
    cases = [random_case(case, rng) for case in range(300)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        check_cases(spark, cases)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_hot_keys(spark):
    """One item and one SKU hold most of the rows; the digest shrinks them to a row a branch."""
    n = F.col("id")
    hot = spark.range(200_000).select(
        F.when(n % 3 == 0, 2).otherwise(1).alias("phase"),
        (F.when(n % 3 == 0, 10_000_000).otherwise(0) + n).cast("bigint").alias("ord"),
        F.when(n % 3 == 0, None).when(n % 3 == 1, "hot item")
        .otherwise(F.concat(F.lit("i"), n.cast("string"))).alias("item"),
        F.when(n % 3 == 0, "hot sku").otherwise(F.concat(F.lit("s"), n.cast("string")))
        .alias("sku"),
        F.concat(F.lit("B"), (n % 4).cast("string")).alias("branch"),
        n.cast("double").alias("qty"),
    )
    done = r.reconcile(hot)
    assert done.digest.where("item = 'hot item' or sku = 'hot sku'").count() == 8
    found = {
        (row.item, row.branch): row.qty
        for row in done.snapshot().where("item in ('hot item', 'hot sku')").collect()
    }
    assert found == {
        ("hot item", f"B{b}"): float(max(i for i in range(199_900, 200_000)
                                         if i % 3 == 1 and i % 4 == b)) for b in range(4)
    } | {
        ("hot sku", f"B{b}"): float(max(i for i in range(199_900, 200_000)
                                        if i % 3 == 0 and i % 4 == b)) for b in range(4)
    }


def test_nested_and_back(spark):
    done = r.reconcile(spark.createDataFrame(GOLDEN, FEED))
    nested = r.nested(done.snapshot())
    assert nested.count() == 5
    gum = nested.where("sku = 'S7'").first()
    assert gum.branches == {"HQ": 20.0, "On Time": 8.0, "Saimai": -1.0}
    assert rows(r.explode_branches(nested)) == [row[:4] for row in GOLDEN_SNAPSHOT]


def test_last_per_branch(spark):
    last = r.last_per_branch(spark.createDataFrame(GOLDEN, FEED))
    assert ("Floss", "Circle", 6.0) in rows(last)
    assert last.where("item is null").count() == 0
