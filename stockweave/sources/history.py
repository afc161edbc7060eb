"""Snapshot history, its catalog and the latest snapshot.

Every append writes its rows below ``rows/version=<version>``, by date and snapshot, and then adds a
commit to the ``log`` with a line for each snapshot: what it names is published. Commits are numbered
and created only if absent, so two appends at once get two numbers, and the higher one counts,
whatever the clocks of their drivers say. A snapshot is the version that its newest entry names, be
it empty, so a rerun replaces a snapshot as a whole, a failed run publishes nothing, and readers
never see half a write. The catalog is read from the log; no data file is listed for it.
"""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockweave.fixed_values import SNAPSHOT_SUFFIX
from stockweave.functions import naming
from stockweave.schemas import SNAPSHOT
from stockweave.sources import commits

HISTORY = T.StructType(
    SNAPSHOT.fields
    + [
        T.StructField("version", T.StringType()),
        T.StructField("snapshot_date", T.DateType()),
        T.StructField("snapshot_id", T.StringType()),
    ]
)
#: A line of a commit.
ENTRY = "snapshot_id string, snapshot_date date, version string, n_rows bigint"


def new_version() -> str:
    return uuid4().hex


def write_version(rows: DataFrame, path: str, version: str, *partitions: str) -> None:
    """Write a version of rows beside all earlier ones; it counts once the log names it.

    It has a folder of its own, so that writers at the same time do not touch each other's files.
    """
    rows.write.partitionBy(*partitions).parquet(f"{path}/version={version}")


def append_snapshots(
    rows: DataFrame, root: str, stamps: DataFrame | None = None, version: str | None = None,
    seen: int | None = None,
) -> int:
    """Write snapshot rows with their ``snapshot_ts``; there may be several snapshots at once.

    ``stamps`` lists the ``snapshot_ts`` of all snapshots, which may include ones without rows.
    Rows are sorted by branch within a file, which lets a branch filter skip row groups. ``seen`` is
    the last commit that the writer knows of, by default the last one there is. Answers the number
    of the commit; one short line for each snapshot passes through the driver.
    """
    spark, version = rows.sparkSession, version or new_version()
    date, name = F.to_date("snapshot_ts"), naming.snapshot_name(F.col("snapshot_ts"))
    stamped = rows.select(
        *SNAPSHOT.names, date.alias("snapshot_date"), name.alias("snapshot_id")
    ).sortWithinPartitions("snapshot_date", "snapshot_id", "branch", "sku")
    write_version(stamped, f"{root}/rows", version, "snapshot_date", "snapshot_id")

    # counted from the written files, so that the rows are computed once
    written = spark.read.schema(HISTORY).parquet(f"{root}/rows/version={version}")
    counts = written.groupBy("snapshot_id", "snapshot_date").agg(F.count("*").alias("n_rows"))
    if stamps is not None:
        empty = stamps.select(
            name.alias("snapshot_id"), date.alias("snapshot_date"), F.lit(0).alias("n_rows")
        )
        counts = counts.unionByName(empty).groupBy("snapshot_id", "snapshot_date").agg(
            F.sum("n_rows").alias("n_rows")
        )
    lines = [
        json.dumps({
            "snapshot_id": row.snapshot_id, "snapshot_date": str(row.snapshot_date),
            "version": version, "n_rows": row.n_rows,
        })
        for row in counts.collect()
    ]
    return commits.commit(spark, f"{root}/log", "\n".join(lines) + "\n", seen)


def gathered(rows: DataFrame) -> DataFrame:
    """Bring the rows of a snapshot together before a write of many snapshots.

    The rebalance lets Spark split a snapshot which is too large for one task.
    """
    return rows.hint("rebalance", F.col("snapshot_ts"))


def log_entries(spark: SparkSession, root: str) -> DataFrame:
    """All lines of the log with the number of their commit."""
    number = F.substring_index("_metadata.file_name", ".", 1).cast("bigint")
    try:
        log = spark.read.schema(ENTRY).option("mode", "FAILFAST").json(f"{root}/log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{ENTRY}, number bigint")
    return log.select("*", number.alias("number"))


def published(spark: SparkSession, root: str) -> DataFrame:
    """The newest log entry of every snapshot, as a whole."""
    newest = F.max_by(F.struct("snapshot_date", "version", "n_rows"), "number").alias("newest")
    return log_entries(spark, root).groupBy("snapshot_id").agg(newest).select("snapshot_id", "newest.*")


def published_rows(spark: SparkSession, root: str, table: DataFrame) -> DataFrame:
    """Rows of a versioned table whose version the log names."""
    versions = published(spark, root).select("snapshot_id", "version")
    return table.join(versions, ["snapshot_id", "version"], "left_semi").drop("version")


def read_history(spark: SparkSession, root: str) -> DataFrame:
    rows = spark.read.schema(HISTORY).parquet(f"{root}/rows")
    return published_rows(spark, root, rows).select(
        *[field.name for field in HISTORY if field.name != "version"]
    )


def file_names(spark: SparkSession, folder: str) -> DataFrame:
    """Names of what lies right in a folder: files, and folders of snapshots in parts, which may be
    partitions (``file=<name>``). One name per nightly run comes to the driver."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = [(f.getPath().getName().rsplit("=", 1)[-1],) for f in listed]
    return spark.createDataFrame(names, "file_name string")


def snapshot_ids(spark: SparkSession, root: str) -> DataFrame:
    """Snapshots of a history as file names, from its log."""
    names = F.concat("snapshot_id", F.lit(SNAPSHOT_SUFFIX))
    return published(spark, root).select(names.alias("file_name"))


def catalog(names: DataFrame) -> DataFrame:
    """Snapshots newest first, by the time in their name; other files are left out."""
    return (
        names.where(naming.is_snapshot_file(F.col("file_name")))
        .select("file_name", naming.snapshot_ts(F.col("file_name")).alias("snapshot_ts"))
        .where(F.col("snapshot_ts").isNotNull())
        .orderBy(F.col("snapshot_ts").desc(), "file_name")
    )


def malformed_names(names: DataFrame) -> DataFrame:
    """Snapshot files whose name holds no time."""
    name = F.col("file_name")
    return names.where(naming.is_snapshot_file(name) & naming.snapshot_ts(name).isNull())


def snapshot_count(catalog_: DataFrame) -> DataFrame:
    return catalog_.agg(F.count(F.lit(1)).alias("snapshots"))


def latest_name(catalog_: DataFrame) -> DataFrame:
    return catalog_.select("file_name", "snapshot_ts").limit(1).select("file_name")


def with_labels(catalog_: DataFrame) -> DataFrame:
    return catalog_.select("file_name", naming.snapshot_label(F.col("snapshot_ts")).alias("label"))


def with_last_updated(catalog_: DataFrame) -> DataFrame:
    """Time shown with an opened snapshot."""
    return catalog_.select("file_name", naming.time_text(F.col("snapshot_ts")).alias("last_updated"))


def snapshot_at(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One snapshot, by name with or without suffix. Its entry in the log comes to the driver, and
    only the folder that the entry names is listed and read."""
    snapshot_id = name.removesuffix(SNAPSHOT_SUFFIX)
    entry = published(spark, root).where(F.col("snapshot_id") == snapshot_id).first()
    if entry is None or not entry.n_rows:
        return spark.createDataFrame([], SNAPSHOT)
    folder = f"version={entry.version}/snapshot_date={entry.snapshot_date}/snapshot_id={snapshot_id}"
    return spark.read.schema(SNAPSHOT).parquet(f"{root}/rows/{folder}")


def latest_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """View on the newest snapshot. One name comes to the driver, to pick the folder."""
    newest = latest_name(catalog(snapshot_ids(spark, root))).first()
    if newest is None:
        return spark.createDataFrame([], SNAPSHOT)
    return snapshot_at(spark, root, newest.file_name)


def index_text(catalog_: DataFrame, indent: int | None = None) -> DataFrame:
    """The catalog as one JSON array, newest first. It has one short name per nightly run."""
    newest_first = F.sort_array(F.collect_list(F.struct("snapshot_ts", "file_name")), asc=False)
    names = F.transform(newest_first, lambda entry: entry["file_name"])
    return catalog_.agg(_json_array(names, indent).alias("value"))


def _json_array(names: Column, indent: int | None) -> Column:
    if indent is None:
        return F.to_json(names)
    quoted = F.transform(names, lambda name: F.concat(F.lit('"'), name, F.lit('"')))
    pad = "\n" + " " * indent
    lines = F.concat(F.lit("[" + pad), F.array_join(quoted, "," + pad), F.lit("\n]"))
    return F.when(F.size(names) > 0, lines).otherwise(F.lit("[]"))


def write_index(
    catalog_: DataFrame, path: str, indent: int | None = None, number: int | None = None
) -> None:
    """Write the index beside the earlier ones; the one with the highest number counts.

    ``number`` is that of the last commit that the catalog shows: of two writers at once the one that
    saw more wins, and what is there already stays. Without it, the next free number is taken. The
    index is one short text by its nature. A write that fails leaves the old index as it is, and a
    reader never finds half of one.
    """
    text, spark = index_text(catalog_, indent).first()[0], catalog_.sparkSession
    if number is None:
        commits.commit(spark, path, text)
    else:
        commits.create_if_absent(spark, commits.path_of(path, number), text)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Catalog from the newest index file, in the order of the file."""
    newest = commits.path_of(path, commits.last_number(spark, path))
    names = F.from_json("value", "array<string>")
    listed = spark.read.text(newest, wholetext=True).select(
        F.posexplode(names).alias("position", "file_name")
    )
    return listed.orderBy("position").select(
        "file_name", naming.snapshot_ts(F.col("file_name")).alias("snapshot_ts")
    )
