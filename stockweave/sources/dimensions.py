"""Small tables from the configuration."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def small_table(spark: SparkSession, columns: Mapping[str, list]) -> DataFrame:
    """Columns of configured values as a table whose size Spark knows.

    Because of the known size the optimizer broadcasts it while it is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
    """
    return spark.createDataFrame(pa.table(dict(columns)))


def alias_table(spark: SparkSession, aliases: Mapping[str, str]) -> DataFrame:
    return small_table(spark, {
        "source_sku": pa.array(list(aliases.keys()), pa.string()),
        "canonical_sku": pa.array(list(aliases.values()), pa.string()),
    })


def branch_table(spark: SparkSession, groups: Mapping[str, Iterable[str]]) -> DataFrame:
    pairs = [(branch, group) for group, branches in groups.items() for branch in branches]
    return small_table(spark, {
        "branch": pa.array([branch for branch, _ in pairs], pa.string()),
        "branch_group": pa.array([group for _, group in pairs], pa.string()),
    })
