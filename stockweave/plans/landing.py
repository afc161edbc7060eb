"""Landed files for the registered queries: tables written as the feeds' sheets and lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rows of one landed sheet; a table lands as many of them.
ROWS_PER_FILE = 4_000


def land_sheet(
    rows: DataFrame, ord_: str, path: str, lead: list[tuple], header: bool
) -> str:
    """Land rows as sheets of a limited size, each with the given lines on top.

    ``rows`` has ``ord_`` plus the string columns of the sheet; file names follow the order.
    """
    cells = [name for name in rows.columns if name != ord_]
    sheet = F.lpad(F.floor(F.col(ord_) / ROWS_PER_FILE).cast("string"), 10, "0")
    body = rows.select(
        sheet.alias("sheet"), F.col(ord_).alias("line"),
        *[F.col(cell).cast("string").alias(cell) for cell in cells],
    )
    if lead:
        lines = F.array(*[
            F.struct(
                F.lit(n - len(lead)).cast("bigint").alias("line"),
                *[F.lit(text).cast("string").alias(cell)
                  for cell, text in zip(cells, texts, strict=True)],
            )
            for n, texts in enumerate(lead)
        ])
        tops = body.select("sheet").distinct().select("sheet", F.inline(lines))
        body = body.unionByName(tops)
    (
        body.repartition("sheet").sortWithinPartitions("sheet", "line").drop("line")
        .write.partitionBy("sheet").option("header", header).option("escape", '"').csv(path)
    )
    return path


def no_cells(count: int) -> list[Column]:
    return [F.lit(None).cast("string").alias(f"n{n}") for n in range(count)]


def land_stores(stock: DataFrame, path: str, mode: str = "error") -> str:
    """Store tables; ``stock`` has event_id, store, item, sku, qty. Mode ``overwrite`` lands the stores
    in ``stock`` again and leaves the others as they are."""
    (
        stock.select(
            F.col("store").alias("branch"), "event_id", F.col("item").alias("Item"),
            F.col("sku").alias("SKU"), F.col("qty").alias("Available Qty."),
        )
        .repartitionByRange("branch", "event_id")
        .sortWithinPartitions("branch", "event_id")
        .withColumnRenamed("event_id", "No.")
        .write.mode(mode).option("partitionOverwriteMode", "dynamic")
        .partitionBy("branch").option("header", True).csv(path)
    )
    return path


def land_products(products: DataFrame, path: str) -> str:
    """Product lists of 1,000 entries, one per line; ``products`` has event_id, sku, stock."""
    entry = F.struct(F.col("sku"), F.col("stock").alias("availablestock"))
    in_order = F.transform(
        F.sort_array(F.collect_list(F.struct("event_id", entry.alias("entry")))),
        lambda row: row["entry"],
    )
    (
        products.groupBy(F.floor(F.col("event_id") / 1000).alias("page"))
        .agg(F.to_json(F.struct(in_order.alias("list"))).alias("value"))
        .repartitionByRange("page").sortWithinPartitions("page")
        .select("value").write.text(path)
    )
    return path


def land_lists(products: DataFrame, path: str) -> str:
    """Product lists that are one document a file; ``products`` as for :func:`land_products`."""
    entry = F.struct(F.col("sku"), F.col("stock").alias("availablestock"))
    in_order = F.transform(
        F.sort_array(F.collect_list(F.struct("event_id", entry.alias("entry")))),
        lambda row: row["entry"],
    )
    body = F.struct(F.lit("{ }").alias("note"), in_order.alias("list"), F.struct(F.lit(0).alias("code")).alias("state"))
    page = F.lpad(F.floor(F.col("event_id") / ROWS_PER_FILE).cast("string"), 10, "0")
    (
        products.groupBy(page.alias("page")).agg(F.to_json(body).alias("value"))
        .write.partitionBy("page").text(path)
    )
    return path


def land_vending(stock: DataFrame, path: str) -> str:
    """Vending tables of 8 columns; ``stock`` has event_id, branch, sku, qty."""
    rows = stock.select(
        "event_id", *no_cells(2), F.col("branch").alias("c2"), F.col("sku").alias("c3"),
        *[column.alias(f"m{n}") for n, column in enumerate(no_cells(3))],
        F.col("qty").cast("string").alias("c7"),
    )
    lead = [
        ("Stock report",) + (None,) * 7,
        (None,) * 8,
        ("no", "id", "site", "code", "a", "b", "c", "left"),
    ]
    return land_sheet(rows, "event_id", path, lead, header=False)


def land_hq(stock: DataFrame, path: str) -> str:
    """Head office sheets of 8 columns; ``stock`` has event_id, sku, item, qty."""
    rows = stock.select(
        "event_id", *no_cells(2), F.col("sku").alias("Code"), F.col("item").alias("Name"),
        *[column.alias(f"m{n}") for n, column in enumerate(no_cells(3))],
        F.col("qty").cast("string").alias("Left"),
    )
    lead = [(None, None, "group", "group", None, None, None, "99")] * 2
    return land_sheet(rows, "event_id", path, lead, header=True)


def land_depot(stock: DataFrame, path: str, ord_: str = "event_id") -> str:
    """Depot sheets of 7 columns; ``stock`` has an ordinal, sku, item, qty."""
    rows = stock.select(
        ord_, *no_cells(1), F.col("sku").alias("Code"), F.col("item").alias("Name"),
        *[column.alias(f"m{n}") for n, column in enumerate(no_cells(3))],
        F.col("qty").cast("string").alias("Left"),
    )
    return land_sheet(rows, ord_, path, [], header=True)


def land_lines(lines: DataFrame, ord_: str, path: str, header: str) -> str:
    """Land ready-made lines of text as sheets with a header; ``lines`` has ``ord_`` and value."""
    sheet = F.lpad(F.floor(F.col(ord_) / ROWS_PER_FILE).cast("string"), 10, "0")
    body = lines.select(sheet.alias("sheet"), F.col(ord_).cast("bigint").alias("line"), "value")
    tops = body.select("sheet").distinct().select(
        "sheet", F.lit(-1).cast("bigint").alias("line"), F.lit(header).alias("value")
    )
    (
        body.unionByName(tops).repartition("sheet").sortWithinPartitions("sheet", "line").drop("line")
        .write.partitionBy("sheet").text(path)
    )
    return path
