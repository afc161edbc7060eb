"""Questions to one snapshot."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from stockweave.functions.stock import matches_search, quantity_text, stock_band
from stockweave.operators.selection import Order, before, equal, rows_between, sort_columns
from stockweave.sources.staging import stage


def select_branches(snapshot: DataFrame, branches: Iterable[str] | None) -> DataFrame:
    """Rows of the chosen branches; ``None`` means all, an empty choice means no rows."""
    if branches is None:
        return snapshot
    chosen = list(branches)
    return snapshot.where(F.col("branch").isin(*chosen) if chosen else F.lit(False))


def rollup(snapshot: DataFrame, branches: Iterable[str] | None = None) -> DataFrame:
    """Total quantity per SKU over the chosen branches. The item is the same in all its rows."""
    return (
        select_branches(snapshot, branches)
        .groupBy("sku", "item")
        .agg(F.sum("qty").alias("qty"))
    )


def with_band(totals: DataFrame) -> DataFrame:
    return totals.withColumn("band", stock_band(F.col("qty")))


def distinct_branches(snapshot: DataFrame) -> DataFrame:
    return snapshot.select("branch").distinct()


def search(rows: DataFrame, text: str, *columns: Column) -> DataFrame:
    return rows.where(matches_search(text, *columns))


def table_columns() -> tuple[Column, Column, Column]:
    """What a row of the table shows."""
    return F.col("sku"), F.col("item"), quantity_text(F.col("qty"))


def table_info(rows: DataFrame, text: str, *columns: Column) -> DataFrame:
    """Number of rows, and of those which match the search."""
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(matches_search(text, *columns)).alias("shown"),
    )


def number_rows(rows: DataFrame, *order: Column) -> DataFrame:
    """Global row number in the given order, without a window over the whole table.

    The sorted ranges are staged once, each row with its range and its place in it. Adding the
    sizes of the earlier ranges, one row per range, gives the global number. The order has to be
    total.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranges = stage(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_place", place),
        "ranges",
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(
        ranges.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")),
        "range-starts",
    )
    return (
        ranges.join(starts, "_range")
        .withColumn("row_no", F.col("_start") + F.col("_place") + 1)
        .drop("_range", "_place", "_start")
    )


def page(rows: DataFrame, page_no: int, size: int | None, order: Order) -> DataFrame:
    """Page ``page_no`` (from 0) of the sorted rows; ``size`` None shows all of them.

    The page is selected by counting, at every depth alike: nothing is written, and no more than a
    few pages' worth of rows are sorted. To leaf from page to page, :func:`page_after` needs no
    counts.
    """
    if size is None:
        return rows.orderBy(*sort_columns(order))
    return rows_between(rows, page_no * size, size, order)


def page_after(rows: DataFrame, size: int, order: Order, last: Sequence | None = None) -> DataFrame:
    """The ``size`` rows that follow the row with the key ``last``: a top-k of just them.

    ``order`` has to be total; ``last`` has the values of its columns in the last row of the page
    before, None for the first page.
    """
    if last is not None:
        rows = rows.where(~before(order, last) & ~equal(order, last))
    return rows.orderBy(*sort_columns(order)).limit(size)
