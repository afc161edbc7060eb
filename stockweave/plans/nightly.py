"""The nightly run: landed feeds in, one snapshot in the history out.

Steps: read and stage the feeds, drop skipped and bad rows, reconcile, write the reports, the
snapshot and its document, publish them by one entry in the history's log, rebuild the index. A
required feed which is missing or bad raises before anything is published; an optional one is noted
in the feed status. All that is staged on the way is dropped at the end.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.fixed_values import SNAPSHOT_SUFFIX
from stockweave.functions import naming
from stockweave.operators.prefix import split_at, with_first_bad
from stockweave.operators.projection import leading_cuts, skip_leading
from stockweave.operators.reconcile import Reconciliation, reconcile
from stockweave.schemas import FEED, FEED_STATUS, REJECTS, with_version
from stockweave.sources import commits, documents, history
from stockweave.sources.dimensions import small_table
from stockweave.sources.feeds import (
    FeedError,
    FeedSpec,
    UnitStatus,
    by_header,
    is_file_fault,
    landed_units,
    read_units,
    status_of,
)
from stockweave.sources.staging import scope, stage

WIDE_ROW = "a row with more cells than the header"


@dataclass(frozen=True)
class CleanFeed:
    """Clean records, rejected rows and the fate of each unit."""

    records: DataFrame
    rejects: DataFrame
    status: DataFrame


def union(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def stage_feed(
    spark: SparkSession, spec: FeedSpec
) -> tuple[DataFrame | None, dict[str, UnitStatus]]:
    """Parse a feed into a staged table, together with what became of its units.

    All units are read in one scan. Files that cannot be read end a required feed; of an optional
    one those units are lost whose header the others do not share or whose files are broken. Errors
    of the cluster end the run.
    """
    landed, missing = landed_units(spark, spec)
    if missing and spec.required:
        raise FeedError(f"{spec.name}: no files for {missing}")
    states = {unit: status_of(spec, unit, "failed", "no files") for unit in missing}
    if not landed:
        return None, states
    staged, groups = [], [landed]
    while groups:
        units = groups.pop(0)
        try:
            staged.append(stage(read_units(spark, spec, units, landed), spec.name))
            states |= {unit: status_of(spec, unit, "read") for unit in units}
        except (FeedError, PySparkException, Py4JError) as error:
            if spec.required or not is_file_fault(error):
                raise
            smaller = by_header(spark, spec, units) if len(units) > 1 else []
            if len(smaller) == 1:
                smaller = [[unit] for unit in units]
            groups += smaller
            if not smaller:
                states |= {units[0]: status_of(spec, units[0], "failed", error_text(error))}
    return (union(staged) if staged else None), states


def error_text(error: Exception) -> str:
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    return condition or str(error).split("\n", 1)[0]


def without_lead(staged: Sequence[tuple[FeedSpec, DataFrame]]) -> list[DataFrame]:
    """The rows of each feed without those its files start with, and without empty ones if they are
    to be dropped."""
    leading = [parsed.withColumn("n", F.lit(spec.skip_rows)) for spec, parsed in staged if spec.skip_rows]
    cuts = leading_cuts(union(leading), F.col("n"), "ord", "phase", "file") if leading else None
    tables = []
    for spec, parsed in staged:
        rows = skip_leading(parsed, cuts, "ord", "phase", "file") if spec.skip_rows else parsed
        tables.append(rows.where(~F.col("empty") | F.col("wide")) if spec.drop_empty else rows)
    return tables


def unit_facts(tables: Sequence[DataFrame]) -> DataFrame:
    """First bad row of each unit and how many of its rows are too wide: one aggregation over all
    feeds."""
    facts = union(tables).groupBy(F.col("phase").alias("_phase"), F.col("unit").alias("_unit")).agg(
        F.min(F.when(F.col("bad"), F.col("ord"))).alias("_first_bad"),
        F.count_if("wide").alias("_wide_rows"),
    )
    return stage(facts, "unit-facts")


def clean_feed(
    rows: DataFrame, spec: FeedSpec, first_bad: DataFrame, failed: Sequence[str]
) -> tuple[DataFrame, list[DataFrame]]:
    """Clean records of one feed, and its rejected rows by reason.

    A row with more cells than its header may have them in the wrong columns. It ends a required
    feed and fails its unit in an optional one; where bad rows are rejected singly, so is this one.
    """
    rejects = []
    if spec.on_bad == "reject_row":
        rejects.append(rows.where("wide").withColumn("reason", F.lit(WIDE_ROW)))
        rows = rows.where(~F.col("wide"))
        rejects.append(rows.where("bad").withColumn("reason", F.lit("bad quantity")))
        rows = rows.where(~F.col("bad"))
    elif failed:
        rows = rows.where(~F.col("unit").isin(*failed))
    if spec.on_bad == "prefix":
        rows, lost = split_at(with_first_bad(rows, first_bad, ["phase", "unit"]), "ord")
        reason = F.when(F.col("bad"), "bad quantity").otherwise("after a bad quantity")
        rejects.append(lost.withColumn("reason", reason))
    # A feed which matches by SKU has no item to miss.
    no_key = F.col("sku").isNull() | F.col("branch").isNull()
    if spec.item is not None:
        no_key = no_key | F.col("item").isNull()
    rejects.append(rows.where(no_key).withColumn("reason", F.lit("no item or SKU")))
    rows = rows.where(~no_key)
    if spec.positive_only:
        rows = rows.where(F.col("qty") > 0)
    return rows.select(*FEED.names), [table.select(*REJECTS.names) for table in rejects]


def read_feeds(spark: SparkSession, specs: Sequence[FeedSpec]) -> CleanFeed:
    """Read, stage and clean all feeds in the order of their phases."""
    staged, units = [], {}
    for spec in sorted(specs, key=lambda spec: spec.phase):
        parsed, units[spec.name] = stage_feed(spark, spec)
        if parsed is not None:
            staged.append((spec, parsed))
    records, rejects, counts = [], [], []
    if staged:
        tables = without_lead(staged)
        facts = unit_facts(tables)
        wide = facts.where("_wide_rows > 0").select("_phase", "_unit").collect()
        for (spec, parsed), rows in zip(staged, tables, strict=True):
            failed = [row._unit for row in wide if row._phase == spec.phase]
            if spec.on_bad == "reject_row":
                failed = []
            if failed and spec.required:
                raise FeedError(f"{spec.name}: {WIDE_ROW}")
            units[spec.name] |= {unit: status_of(spec, unit, "failed", WIDE_ROW) for unit in failed}
            clean, rejected = clean_feed(rows, spec, facts.drop("_wide_rows"), failed)
            records.append(clean)
            rejects += rejected
            counts.append(parsed.groupBy("phase", "unit").agg(F.count(F.lit(1)).alias("n_rows")))
    states = [
        units[spec.name][unit] for spec in sorted(specs, key=lambda spec: spec.phase)
        for unit in (spec.stores or (spec.name,))
    ]
    return CleanFeed(
        records=union([spark.createDataFrame([], FEED), *records]),
        rejects=union([spark.createDataFrame([], REJECTS), *rejects]),
        status=feed_status(spark, states, counts),
    )


def feed_status(
    spark: SparkSession, states: Sequence[UnitStatus], counts: Sequence[DataFrame]
) -> DataFrame:
    """One row per configured unit with the number of rows read from it."""
    units = small_table(spark, {
        "feed": pa.array([state.feed for state in states], pa.string()),
        "phase": pa.array([state.phase for state in states], pa.int32()),
        "unit": pa.array([state.unit for state in states], pa.string()),
        "required": pa.array([state.required for state in states], pa.bool_()),
        "status": pa.array([state.status for state in states], pa.string()),
        "detail": pa.array([state.detail for state in states], pa.string()),
    })
    nothing = spark.createDataFrame([], "phase int, unit string, n_rows bigint")
    counted = union([nothing, *counts])
    return units.join(counted, ["phase", "unit"], "left").select(
        "feed", "phase", "unit", "required", "status", "detail",
        F.coalesce("n_rows", F.lit(0).cast("bigint")).alias("n_rows"),
    )


def all_rejects(clean: CleanFeed, reconciled: Reconciliation) -> DataFrame:
    """Rows lost in cleaning, and those dropped because an item is named like their SKU."""
    clashes = reconciled.dropped().withColumn("reason", F.lit("SKU is the name of an item"))
    return clean.rejects.unionByName(clashes.select(*REJECTS.names))


def local_timestamp(as_of: datetime) -> Column:
    """The run's time on the shop clock, as a literal."""
    utc = as_of.astimezone(timezone.utc).replace(tzinfo=None)
    return naming.local_time(F.lit(utc.isoformat(sep=" ", timespec="seconds")).cast("timestamp_ntz"))


def run(
    spark: SparkSession, specs: Sequence[FeedSpec], root: str, as_of: datetime,
    skus_per_document: int = documents.SKUS_PER_DOCUMENT, incremental: bool = False,
) -> None:
    """One nightly run at ``as_of`` (an aware time).

    An ``incremental`` run keeps what it knows of each landed file below ``root``, and reads only files
    which are new or changed since the last one; its result is the same.

    Writes ``rejects``, ``feed_status``, ``documents`` and ``history`` below ``root``, all under one
    version, which the history's log publishes at last; a rerun replaces all four. The index is
    rebuilt from the log even if the run fails. Snapshot names without a time, which the index
    leaves out, are among the rejects.
    """
    try:
        with scope(spark):
            version = history.new_version()
            stamp = local_timestamp(as_of)
            if incremental:
                from stockweave.plans.incremental import read_known  # which builds on this module

                clean, reconciled = read_known(spark, specs, f"{root}/state")
            else:
                clean = read_feeds(spark, specs)
                reconciled = reconcile(clean.records)
            names = unnamed_documents(spark, root)
            for name, table in (
                ("rejects", all_rejects(clean, reconciled).unionByName(names)),
                ("feed_status", clean.status),
            ):
                stamped = table.withColumn("snapshot_id", naming.snapshot_name(stamp))
                history.write_version(stamped, f"{root}/{name}", version, "snapshot_id")
            snapshot = stage(reconciled.snapshot(), "snapshot")
            stamps = spark.range(1).select(stamp.alias("snapshot_ts"))
            file_name = stamps.select(naming.file_name(F.col("snapshot_ts"))).first()[0]
            documents.write_documents(
                snapshot, f"{root}/documents/{file_name}/{version}", naming.time_text(stamp),
                skus_per_document,
            )
            rows = snapshot.withColumn("snapshot_ts", stamp)
            history.append_snapshots(rows, f"{root}/history", stamps, version)
    finally:
        rebuild_index(spark, root)


def unnamed_documents(spark: SparkSession, root: str) -> DataFrame:
    """Snapshot names in the documents' folder that hold no time, as rejects."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/documents")
    nothing = spark.createDataFrame([], REJECTS)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return nothing
    names = history.malformed_names(history.file_names(spark, f"{root}/documents"))
    return nothing.unionByName(
        names.select(F.col("file_name").alias("item"), F.lit("no time in the name").alias("reason")),
        allowMissingColumns=True,
    )


def read_report(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``rejects`` or ``feed_status`` of the published runs."""
    layout = {"rejects": REJECTS, "feed_status": FEED_STATUS}[name]
    table = spark.read.schema(with_version(layout)).parquet(f"{root}/{name}")
    return history.published_rows(spark, f"{root}/history", table)


def read_document(spark: SparkSession, root: str, name: str) -> DataFrame:
    """SKU rows of the published document of a snapshot."""
    snapshot_id = name.removesuffix(SNAPSHOT_SUFFIX)
    entry = history.published(spark, f"{root}/history").where(
        F.col("snapshot_id") == snapshot_id
    ).first()
    if entry is None:
        raise FileNotFoundError(name)
    folder = f"{root}/documents/{snapshot_id}{SNAPSHOT_SUFFIX}/{entry.version}"
    return documents.read_documents(spark, folder)


def rebuild_index(spark: SparkSession, root: str) -> None:
    """Write the index that the log gives, under the number of the last commit it shows."""
    number = commits.last_number(spark, f"{root}/history/log")
    names = history.snapshot_ids(spark, f"{root}/history")
    history.write_index(history.catalog(names), f"{root}/index", number=number)
