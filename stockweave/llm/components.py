"""Connected components of a graph of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.frames import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is its smallest node.

    Alternates large stars (link every larger neighbour to the smallest one) and small stars (link
    the smaller neighbours and the node itself to the smallest) until nothing changes. Each star is
    an aggregation with partial results and a join on the aggregated table, so no node's neighbours
    ever meet in one task; the number of rounds grows with the logarithm of the longest path.
    Every round is written to the shared folder, which cuts the lineage.
    Edges with a null end and loops count for nothing.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars = stage(pairs.distinct(), "edges")
    state = _fingerprint(stars)
    while state[0]:
        stars = _small_star(_large_star(stars))
        before, state = state, _fingerprint(stars)
        if state == before:
            break
    roots = stars.select(F.col("b").alias("node")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _fingerprint(pairs: DataFrame) -> tuple:
    """The number of edges and a sum over them, of any size, that does not depend on their order."""
    mixed = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(pairs.agg(F.count("*"), F.sum(mixed)).first())


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")), "least")
    linked = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return stage(linked.filter("a <> b").distinct(), "large-star")


def _small_star(pairs: DataFrame) -> DataFrame:
    least = stage(pairs.groupBy("a").agg(F.min("b").alias("root")), "least")
    inner = pairs.join(least, "a").filter("b <> root").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return stage(inner.unionByName(least.select("a", F.col("root").alias("b"))).distinct(), "small-star")
