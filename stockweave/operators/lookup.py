"""Lookups with a default."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def map_or_default(
    df: DataFrame, key: str, table: DataFrame, value: str, default: Column, into: str
) -> DataFrame:
    """Left join ``df.key`` with the first column of ``table`` and fill gaps with ``default``.

    ``table`` has unique keys. Its known size decides between broadcast and shuffle.
    """
    table_key = next(name for name in table.columns if name != value)
    side = table.select(F.col(table_key).alias("_key"), F.col(value).alias("_value"))
    joined = df.join(side, F.col(key) == F.col("_key"), "left")
    return joined.withColumn(into, F.coalesce(F.col("_value"), default)).drop("_key", "_value")


def canonical_sku(df: DataFrame, aliases: DataFrame, sku: str = "sku") -> DataFrame:
    """Replace a source SKU by its canonical one; SKUs without an alias stay."""
    return map_or_default(df, sku, aliases, "canonical_sku", F.col(sku), sku)


def with_branch_group(df: DataFrame, branches: DataFrame) -> DataFrame:
    """Add the group of the branch; unlisted branches have the group ""."""
    return map_or_default(df, "branch", branches, "branch_group", F.lit(""), "branch_group")
