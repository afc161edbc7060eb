from __future__ import annotations

import random

from pyspark.sql import functions as F

from stockweave.llm.components import _fingerprint, connected_components
from tests.llm import tables


def check(spark, pairs, kind="long"):
    edges = spark.createDataFrame(pairs, f"a {kind}, b {kind}")
    found = {r.node: r.component for r in connected_components(edges).collect()}
    real = {frozenset(p) for p in pairs if None not in p and p[0] != p[1]}
    nodes = sorted({n for p in real for n in p})
    assert found == tables.components(nodes, lambda a, b: frozenset((a, b)) in real)


def test_random_graphs_match_brute_force(spark):
    generator = random.Random(1)
    for nodes, edges in ((40, 20), (60, 60), (30, 100)):
        check(spark, [(generator.randrange(nodes), generator.randrange(nodes)) for _ in range(edges)])


def test_long_paths_stars_loops_and_nulls(spark):
    generator = random.Random(2)
    path = list(range(150))
    generator.shuffle(path)
    check(spark, list(zip(path, path[1:])))
    check(spark, [(500, i) for i in range(100)] + [(1, 1), (None, 3), (4, None), (7, 500), (7, 500)])
    check(spark, [("b", "a"), ("c", "b"), ("z", "y")], "string")


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_the_fingerprint_of_many_edges(spark):
    """Their hashes add up to more than 64 bits; one other edge makes a difference."""
    n = 17_500_000
    pairs = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    other = pairs.withColumn("b", F.when(F.col("a") == 5, 0).otherwise(F.col("b")))
    found = _fingerprint(pairs)
    assert found[0] == n and found == _fingerprint(pairs.repartition(3))
    assert found != _fingerprint(other)
