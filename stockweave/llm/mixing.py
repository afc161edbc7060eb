"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm.frames import read, running_sum, stage

WEIGHTS = (5.0, 2.0, 1.0)
MOST_REPEATS = 3
SEED = 7
WORD = r"[^\x20\x09-\x0D]+"


def word_count(column: str = "text"):
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple = WEIGHTS, repeats: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, target) for every source of ``sized`` (source, size).

    The sources in order of code points, null last, get ``weights`` in turn and share the sum of
    all sizes by them. A target stops at ``repeats`` times its source's size and the excess goes to
    the others by weight: the level at which the water stands is found from running sums over the
    sources, ordered by how early each is full. A source of no words has the target 0.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = stage(sources.withColumn("last", F.col("source").isNull()).withColumn("one", F.lit(1)), "sources")
    ranked = running_sum(sources, [], ["last", "source"], "one", "rank")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.get(turn, ((F.col("rank") - 1) % len(weights)).cast("int"))
    limits = ranked.select("last", "source", "source_size", weight.alias("weight")).withColumns({
        "limit": repeats * F.col("source_size"), "full_at": repeats * F.col("source_size") / F.col("weight"),
    })
    words, shares = limits.agg(F.sum("source_size"), F.sum("weight")).first()
    order = ["full_at", "last", "source"]
    filled = running_sum(limits, [], order, "limit", "limit_sum")
    filled = stage(running_sum(filled, [], order, "weight", "weight_sum"), "limits")
    # the level if just the sources before this one are full; the first one not below it ends the search
    left = F.lit(words) - F.col("limit_sum") + F.col("limit")
    level = left / (F.lit(shares) - F.col("weight_sum") + F.col("weight"))
    reached = filled.withColumn("level", level).filter("full_at >= level")
    water = reached.agg(F.min_by("level", F.struct(*order))).first()[0]
    target = F.least(F.col("limit").cast("double"), F.lit(water) * F.col("weight"))
    return filled.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def mix(documents: DataFrame, weights: tuple = WEIGHTS, repeats: int = MOST_REPEATS, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target and taken, one row for each document.

    Each source is shuffled by a seeded hash and offered ``repeats`` times over. A copy's virtual
    finish time is what its source has sent up to the middle word of the copy, divided by the
    source's target: so the cut rounds to the nearest document instead of always leaving one
    out. All copies are sorted by that time over ranges, and the mix ends where the sum of all
    targets is reached. ``taken`` is ``size`` times the copies before that end.

    Null, empty or blank texts have size 0 and are taken 0 times; a null source is a source of its
    own; rows with equal doc_id are separate documents, told apart by their texts in the shuffle;
    rows that repeat id, source and text each have their own place in the queue. Texts of any length
    are counted whole; other columns are not read; an empty table gives an empty one.
    """
    return _queue(documents, weights, repeats, seed).drop("text_hash")


def _queue(documents: DataFrame, weights: tuple, repeats: int, seed: int) -> DataFrame:
    """The result of ``mix`` with a hash of the text."""
    sized = stage(
        documents.select("doc_id", "source", word_count().alias("size"), F.xxhash64("text").alias("text_hash"))
        .withColumn("place", F.xxhash64(F.lit(seed), "doc_id", "text_hash"))
        # parts rows that are alike, of which it does not matter which comes first
        .withColumn("tie", F.monotonically_increasing_id()), "sizes",
    )
    aims = stage(targets(sized, weights, repeats), "targets")
    queued = running_sum(sized, ["source"], ["place", "doc_id", "size", "text_hash", "tie"], "size", "sent")
    queued = stage(
        queued.alias("q").join(aims.alias("t"), F.col("q.source").eqNullSafe(F.col("t.source")))
        .select("q.*", "source_size", "target"), "queues",
    )
    end = _end_of_mix(queued, repeats)
    copies = sum((F.when(_finish(F.lit(copy)) <= end, 1).otherwise(0) for copy in range(repeats)), F.lit(0))
    taken = F.when((F.col("size") > 0) & (F.col("target") > 0), copies * F.col("size")).otherwise(0)
    return queued.select(
        "doc_id", "source", "text_hash", "size", "source_size", "target", taken.cast("long").alias("taken")
    )


def _finish(copy):
    """The virtual finish time of the middle word of a copy (0, 1, ...) of a document."""
    words = 2 * (copy * F.col("source_size") + F.col("sent")) - F.col("size")
    return words / (2 * F.col("target"))


def _end_of_mix(queued: DataFrame, repeats: int):
    """The latest finish time in the mix."""
    offered = queued.filter("size > 0 and target > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    offered = offered.select(_finish(F.col("copy")).alias("finish"), "size")
    budget = queued.agg(F.sum("size").alias("words")).first()["words"] or 0
    sent = running_sum(offered, [], ["finish", "size"], "size", "sent")
    end = sent.filter(2 * F.col("sent") - F.col("size") <= 2 * budget).agg(F.max("finish").alias("end")).first()["end"]
    return F.lit(end if end is not None else -1.0)


def mixed_documents(
    documents: DataFrame, weights: tuple = WEIGHTS, repeats: int = MOST_REPEATS, seed: int = SEED
) -> DataFrame:
    """The documents of the mix, each as often as it is taken; columns as in ``documents``.

    Rows with one id, source and text share what the mix takes of them all, evenly to within one
    copy, whatever their other columns hold. Rows without words, and empty tables, give no rows.
    """
    key = ["doc_id", "source", "text_hash"]
    plan = stage(
        _queue(documents, weights, repeats, seed).groupBy(*key).agg(
            F.count("*").alias("rows"), F.sum(F.when(F.col("size") > 0, F.col("taken") / F.col("size")).cast("long")).alias("copies")
        ).filter("copies > 0"), "copies",
    )
    rows = documents.select(F.struct("*").alias("row"), "doc_id", "source", F.xxhash64("text").alias("text_hash"))

    def planned(part: DataFrame) -> DataFrame:
        same = F.lit(True)
        for name in key:
            same = same & F.col(f"r.{name}").eqNullSafe(F.col(f"p.{name}"))
        return rows.alias("r").join(part.alias("p"), same).select("r.*", "p.rows", "p.copies")

    single = planned(plan.filter("rows = 1")).select("row", "copies")
    # rows that share a key are numbered over ranges, which cut through a key of many rows
    shared = stage(planned(plan.filter("rows > 1")), "shared").withColumns({
        "tie": F.monotonically_increasing_id(), "one": F.lit(1),
    })
    numbered = running_sum(shared, key, ["tie"], "one", "number")
    share = F.expr("copies DIV rows") + F.when(F.col("number") <= F.col("copies") % F.col("rows"), 1).otherwise(0)
    shared = numbered.select("row", share.alias("copies")).filter("copies > 0")
    repeated = single.unionByName(shared).select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select("row.*")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
