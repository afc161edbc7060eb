"""Exact duplicates: filters of an immutable snapshot screen what comes in."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm.frames import ascii_lower, keep_one_row, read, stage
from stockweave.llm.fuse_filter import FuseFilter

DIGESTS_PER_BUCKET = 50_000
LEAST_ID = -(1 << 63)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def digests(documents: DataFrame, digest=sha256) -> DataFrame:
    """(doc_id, digest), one row for each document."""
    return documents.select("doc_id", digest(ascii_lower(F.col("text"))).alias("digest"))


@dataclass(frozen=True)
class Snapshot:
    """The digests of a table that changes no more.

    entries: digest, last_id, n and the bucket of every distinct digest; filters: one binary-fuse
    filter for each bucket of about ``DIGESTS_PER_BUCKET`` digests.
    """

    entries: DataFrame
    filters: DataFrame
    buckets: int


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int")


def _by_digest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.max("doc_id").alias("last_id"), F.count("*").alias("n"))


def build_snapshot(rows: DataFrame) -> Snapshot:
    """The snapshot of ``rows`` (doc_id, digest)."""
    entries = stage(_by_digest(rows), "entries")
    buckets = max(1, -(-entries.count() // DIGESTS_PER_BUCKET))
    entries = entries.withColumn("bucket", _bucket(buckets))
    filters = entries.select("bucket", "digest").groupBy("bucket").applyInPandas(
        _build_filter, "bucket int, seed long, segment_length int, table binary"
    )
    return Snapshot(entries, stage(filters, "filters"), buckets)


def _keys(column: pd.Series) -> np.ndarray:
    """64-bit keys of digests: their first sixteen hexadecimal digits."""
    return np.array([int(x[:16], 16) for x in column], dtype=np.uint64)


def _build_filter(part: pd.DataFrame) -> pd.DataFrame:
    built = FuseFilter.build(_keys(part["digest"]))
    return pd.DataFrame({
        "bucket": part["bucket"].iloc[:1], "seed": [built.seed],
        "segment_length": [built.segment_length], "table": [built.table.tobytes()],
    })


def screen(incoming: DataFrame, snapshot: Snapshot) -> DataFrame:
    """``incoming`` (digest, ...) with ``maybe``: whether the snapshot's filter lets a digest through.

    False means that the snapshot has no such digest; about 1 of 256 others comes through too.
    """
    schema = incoming.schema.simpleString()[7:-1]
    bucketed = incoming.withColumn("bucket", _bucket(snapshot.buckets))

    def look_up(part: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        part = part.drop(columns="bucket")
        if part.empty or found.empty:
            return part.assign(maybe=False)
        row = found.iloc[0]
        table = np.frombuffer(row["table"], dtype=np.uint8)
        screened = FuseFilter(int(row["seed"]), int(row["segment_length"]), table).contains(_keys(part["digest"]))
        return part.assign(maybe=screened)

    return bucketed.groupBy("bucket").cogroup(snapshot.filters.groupBy("bucket")).applyInPandas(
        look_up, f"{schema.replace(',', ', ').replace(':', ' ')}, maybe boolean"
    )


def repeated_digests(snapshot: Snapshot, batch: DataFrame) -> DataFrame:
    """The digests that snapshot and batch (doc_id, digest) hold more than once, together.

    Positives of the screen meet the snapshot's exact entries; what the screen turns away can only
    repeat within the batch.
    """
    screened = stage(screen(_by_digest(batch), snapshot), "screened")
    old = snapshot.entries.select("digest", F.col("n").alias("old_n"))
    # an outer join: an entry that no positive meets may repeat within the snapshot
    met = screened.filter("maybe").join(old, "digest", "full_outer").select(
        "digest", (F.coalesce("n", F.lit(0)) + F.coalesce("old_n", F.lit(0))).alias("n")
    )
    fresh = screened.filter("not maybe").select("digest", "n")
    return stage(met.unionByName(fresh).filter("n > 1"), "repeated")


def dedup(documents: DataFrame, in_snapshot: Column | None = None, digest=sha256) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of ``documents``.

    Texts are equal if they are the same bytes after lower-casing A-Z; null counts as empty. The
    rows for which ``in_snapshot`` holds (by default half of them, by a hash of doc_id) form the
    immutable snapshot, the others come in against it. Rows whose digest repeats are compared by
    their texts, byte for byte; ``digest`` may collide: what differs is compared again among itself.

    Of equal texts the one with the largest doc_id stays, a null doc_id counts as the smallest. Rows
    which repeat a doc_id and its text each count in group_size and are all marked kept with it
    (``kept_documents`` leaves one). An empty table gives an empty one; other columns are not read.
    """
    rows = stage(documents.select("doc_id", "text").transform(lambda d: digests(d, digest)), "digests")
    if in_snapshot is None:
        in_snapshot = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    snapshot = build_snapshot(rows.filter(in_snapshot))
    repeated = repeated_digests(snapshot, rows.filter(~in_snapshot))
    alone = rows.join(repeated, "digest", "left_anti").select(
        "doc_id", "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")
    )
    text = ascii_lower(F.col("text"))
    # a merge join at every size, so that what is shuffled grows with the table
    pending = stage(
        documents.select("doc_id", text.alias("text")).withColumn("digest", digest(F.col("text")))
        .join(repeated.select("digest").hint("merge"), "digest", "left_semi"), "positives",
    )
    resolved = alone
    while True:
        order = F.coalesce("doc_id", F.lit(LEAST_ID))
        heads = stage(pending.groupBy("digest").agg(
            F.max("doc_id").alias("keep_id"), F.max_by("text", order).alias("head")), "heads")
        checked = pending.join(heads, "digest").withColumn("same", F.col("text") == F.col("head"))
        equal = stage(checked.filter("same").select("doc_id", "digest", "keep_id"), "equal")
        sizes = stage(equal.groupBy("digest").agg(F.count("*").alias("group_size")), "sizes")
        resolved = resolved.unionByName(equal.join(sizes, "digest"))
        rest = checked.filter("not same").select("doc_id", "digest", "text")
        if equal.count() == pending.count():
            break
        pending = stage(rest, "collisions")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return resolved.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("digest").alias("text_sha256"))


def kept_documents(documents: DataFrame) -> DataFrame:
    """One row of ``documents``, whole, for each different text."""
    wanted = dedup(documents).filter("kept").groupBy("doc_id", F.col("text_sha256").alias("digest")).agg(F.count("*").alias("n"))
    rows = documents.select(F.struct("*").alias("row"), "doc_id", sha256(ascii_lower(F.col("text"))).alias("digest"))
    return keep_one_row(rows, ["doc_id", "digest"], stage(wanted, "kept")).select("row.*")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(read(spark, sf_dir, "documents"))
