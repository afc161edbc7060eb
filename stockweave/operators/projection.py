"""Columns by name and position, row offsets, empty rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.sources.staging import stage


def quoted(name: str) -> Column:
    """Column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def pick_positions(df: DataFrame, positions: Mapping[str, int]) -> DataFrame:
    """Columns by position, whatever their header says: ``{"sku": 2, "item": 3}``."""
    return df.select(
        *[quoted(df.columns[position]).alias(name) for name, position in positions.items()]
    )


def drop_all_null(df: DataFrame) -> DataFrame:
    return df.na.drop("all")


def skip_rows(df: DataFrame, n: int, ord_: str) -> DataFrame:
    """Drop the first ``n`` rows of the table by the ordinal: a top-k gives the cut."""
    if n <= 0:
        return df
    cut = df.select(ord_).orderBy(ord_).limit(n).agg(F.max(ord_))
    return df.where(F.col(ord_) > cut.scalar())


def leading_cuts(df: DataFrame, n: Column, ord_: str, *units: str) -> DataFrame:
    """The ordinal of the ``n``-th row of every unit, staged; of a unit with fewer rows, the last one's.

    ``n`` may differ by unit. Each round finds the smallest ordinal behind the last cut, an
    aggregation with partial results: no rows are sorted, and it does not matter how the rows are
    dealt to files, blocks or tasks.
    """
    keys = [F.col(name).alias(f"_{name}") for name in units]
    rows = df.select(*keys, F.col(ord_).alias("_ord"), n.alias("_n")).where("_n > 0")
    names = [f"_{name}" for name in units]
    cuts = stage(rows.groupBy(*names).agg(F.min("_ord").alias("_cut"), F.max("_n").alias("_n")), "row-offset")
    done, most = 1, cuts.agg(F.max("_n")).first()[0] or 0
    while done < most:
        behind = rows.drop("_n").join(cuts.where(F.col("_n") > done), names).where("_ord > _cut")
        following = behind.groupBy(*names).agg(F.min("_ord").alias("_next"))
        cuts = stage(
            cuts.join(following, names, "left").select(*names, F.coalesce("_next", "_cut").alias("_cut"), "_n"),
            "row-offset",
        )
        done += 1
    return cuts.drop("_n")


def skip_leading(df: DataFrame, cuts: DataFrame, ord_: str, *units: str) -> DataFrame:
    """The rows of every unit behind its cut, from :func:`leading_cuts`."""
    same = F.lit(True)
    for name in units:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    kept = df.join(cuts, same).where(F.col(ord_) > F.col("_cut"))
    return kept.drop("_cut", *[f"_{name}" for name in units])
