"""The dashboard's questions to one snapshot: which branches, what to find, in what order."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stockweave.fixed_values import PAGE_SIZES
from stockweave.operators import serving
from stockweave.sources import documents, history

COLUMNS = ("sku", "item", "qty")


@dataclass(frozen=True)
class View:
    """What the user has set. ``branches`` None means all of them, ``size`` None all rows.

    The dashboard offers the sizes in :data:`PAGE_SIZES`.
    """

    branches: Iterable[str] | None = None
    search: str = ""
    order_by: str = "sku"
    descending: bool = False
    page_no: int = 0
    size: int | None = None


def open_snapshot(spark: SparkSession, root: str, name: str | None = None) -> DataFrame:
    """A snapshot by its name, or the latest one."""
    if name is None:
        return history.latest_snapshot(spark, f"{root}/history")
    return history.snapshot_at(spark, f"{root}/history", name)


def pages(rows: DataFrame, view: View) -> dict[int | None, int]:
    """Number of pages for each size on offer."""
    shown = info(rows, view).first().shown
    return {size: 1 if size is None else max(1, -(-shown // size)) for size in PAGE_SIZES}


def totals(snapshot: DataFrame, view: View) -> DataFrame:
    return serving.rollup(snapshot, view.branches)


def order_of(view: View) -> list[tuple[str, bool]]:
    """The chosen column; equal values are in the order of their SKU."""
    if view.order_by not in COLUMNS:
        raise ValueError(f"no column {view.order_by}")
    chosen = (view.order_by, view.descending)
    return [chosen] if view.order_by == "sku" else [chosen, ("sku", False)]


def table(rows: DataFrame, view: View) -> DataFrame:
    """The visible page of the totals, with bands."""
    found = serving.search(rows, view.search, *serving.table_columns())
    visible = serving.page(found, view.page_no, view.size, order_of(view))
    return serving.with_band(visible)


def info(rows: DataFrame, view: View) -> DataFrame:
    return serving.table_info(rows, view.search, *serving.table_columns())


def export(rows: DataFrame, path: str) -> None:
    """All totals of the chosen branches, whatever is searched for or on the page."""
    documents.write_export(rows, path)
