"""Rows of a unit up to its first bad one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.sources.staging import stage


def first_bad(df: DataFrame, unit: Sequence[str], ord_: str, bad: Column) -> DataFrame:
    """Ordinal of the first bad row per unit; units without one are absent.

    Only bad rows are aggregated, with a partial minimum in every task, and the table has one row
    per unit. A window per unit would pull a whole store through one task instead.
    """
    firsts = (
        df.where(bad).groupBy(*[F.col(name).alias(f"_{name}") for name in unit])
        .agg(F.min(ord_).alias("_first_bad"))
    )
    return stage(firsts, "first-bad")


def with_first_bad(df: DataFrame, firsts: DataFrame, unit: Sequence[str]) -> DataFrame:
    same_unit = F.lit(True)
    for name in unit:
        same_unit = same_unit & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return df.join(firsts, same_unit, "left").drop(*[f"_{name}" for name in unit])


def split_at_first_bad(
    df: DataFrame, unit: Sequence[str], ord_: str, bad: Column
) -> tuple[DataFrame, DataFrame]:
    """Rows before the first bad row of their unit, and the rows from there on."""
    return split_at(with_first_bad(df, first_bad(df, unit, ord_, bad), unit), ord_)


def split_at(marked: DataFrame, ord_: str) -> tuple[DataFrame, DataFrame]:
    """Rows before their ``_first_bad``, NULL for none, and the rows from there on."""
    kept = marked.where(F.col("_first_bad").isNull() | (F.col(ord_) < F.col("_first_bad")))
    lost = marked.where(F.col(ord_) >= F.col("_first_bad"))
    return kept.drop("_first_bad"), lost.drop("_first_bad")


def prefix_until_bad(df: DataFrame, unit: Sequence[str], ord_: str, bad: Column) -> DataFrame:
    return split_at_first_bad(df, unit, ord_, bad)[0]
