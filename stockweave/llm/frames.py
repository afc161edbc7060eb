"""Helpers on DataFrames which several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockweave.sources.staging import stage

__all__ = ["ascii_lower", "keep_one_row", "partitions", "read", "running_sum", "stage", "text_batches"]

TEXTS_PER_BATCH = 1_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z alone; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def text_batches(table: DataFrame) -> DataFrame:
    """The same table, in a session that hands texts to Python in batches of a thousand rows at most:
    Spark's own batches are made for numbers, and of texts take hundreds of MB in every worker."""
    conf, key = table.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= TEXTS_PER_BATCH:
        conf.set(key, TEXTS_PER_BATCH)
    return table


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_sum(df: DataFrame, within: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Adds ``out``, the sum of ``value`` over all rows up to this one, by ``within``.

    The rows are dealt out by ranges of (within, order), so a large group spreads over many
    tasks. One sum for each range and group, a table of at most ranges + groups rows, gives what
    lies before a range; a window inside each range gives the rest. Rows which are alike in
    ``order`` get their places at will.
    """
    ranged = stage(
        df.repartitionByRange(partitions(df.sparkSession), *within, *order)
        .withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    earlier = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range", *within).agg(F.sum(value).alias("_sum"))
        .select("_range", *within, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_range", *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    numbered = ranged.withColumn("_inside", F.sum(value).over(inside)).alias("n")
    same = F.col("n._range") == F.col("o._range")
    for name in within:
        same = same & F.col(f"n.{name}").eqNullSafe(F.col(f"o.{name}"))
    return numbered.join(offsets.alias("o"), same).select(
        *[F.col(f"n.{name}") for name in df.columns],
        (F.col("n._inside") + F.col("o._before")).alias(out),
    )


def keep_one_row(rows: DataFrame, keys: list[str], wanted: DataFrame) -> DataFrame:
    """The rows whose ``keys`` are in ``wanted``, one for each key.

    ``wanted`` has the keys and ``n``, how many rows have that key. Only keys with several rows
    need a second shuffle. Keys compare null-safe.
    """
    def matching(part: DataFrame) -> DataFrame:
        condition = F.lit(True)
        for name in keys:
            condition = condition & F.col(f"r.{name}").eqNullSafe(F.col(f"w.{name}"))
        return rows.alias("r").join(part.alias("w"), condition, "left_semi")

    single = matching(wanted.filter("n = 1"))
    return single.unionByName(matching(wanted.filter("n > 1")).dropDuplicates(keys))
