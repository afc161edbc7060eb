from __future__ import annotations

import os
import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from stockweave.fixed_values import BRANCH_GROUPS
from stockweave.functions import stock
from stockweave.operators import lookup, selection, serving
from stockweave.plans import dashboard
from stockweave.schemas import SNAPSHOT
from stockweave.sources import documents, history, staging
from stockweave.sources.dimensions import branch_table

ROWS = [
    ("S1", "Brush A", "Samyan", 1.0, 1), ("S1", "Brush A", "On Time", 12.0, 1),
    ("S2", "Floss", "Samyan", 0.0, 3), ("S2", "Floss", "HQ", 9.5, 3),
    ("S3", "แปรงสีฟัน", "Saimai", 7.0, 4),
]


@pytest.fixture()
def snapshot(spark):
    return spark.createDataFrame(ROWS, SNAPSHOT)


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def test_rollup(snapshot):
    assert rows(serving.rollup(snapshot)) == [
        ("S1", "Brush A", 13.0), ("S2", "Floss", 9.5), ("S3", "แปรงสีฟัน", 7.0),
    ]
    assert rows(serving.rollup(snapshot, ["Samyan", "Nowhere"])) == [
        ("S1", "Brush A", 1.0), ("S2", "Floss", 0.0),
    ]
    assert rows(serving.rollup(snapshot, [])) == []


def test_bands(spark):
    qty = [-1.0, 4.99, 5.0, 9.99, 10.0, float("nan")]
    df = serving.with_band(spark.createDataFrame([(q,) for q in qty], "qty double"))
    assert [row.band for row in df.collect()] == [
        "critical", "critical", "low", "low", "normal", "normal",
    ]


def test_groups(spark, snapshot):
    expected = {"Samyan": "store", "On Time": "online", "HQ": "hq", "Saimai": ""}
    by_case = snapshot.select("branch", stock.branch_group(F.col("branch")).alias("g"))
    assert {row.branch: row.g for row in by_case.collect()} == expected
    joined = lookup.with_branch_group(snapshot, branch_table(spark, BRANCH_GROUPS))
    assert {row.branch: row.branch_group for row in joined.collect()} == expected


@pytest.mark.parametrize(("text", "expected"), [
    ("", 3), ("brush", 1), ("S 1", 1), ("FLOSS 9.5", 1), ("floss 13", 0), ("สีฟัน", 1),
    ('"brush a"', 1), ('"a brush"', 0), ('"s1 brush"', 0), ('"brush a 13"', 0), ('"a  13"', 0), ("a  brush", 1), ("13.0", 0),
])
def test_search(snapshot, text, expected):
    totals = serving.rollup(snapshot)
    assert serving.search(totals, text, *serving.table_columns()).count() == expected
    info = serving.table_info(totals, text, *serving.table_columns()).first()
    assert tuple(info) == (3, expected)


def test_pages(spark):
    skus = spark.range(1000).select(F.format_string("%05d", "id").alias("sku")).repartition(7)

    def page(*where):
        return [int(row.sku) for row in serving.page(skus, *where, [("sku", False)]).collect()]

    assert page(0, 30) == list(range(30))
    assert page(2, 30) == list(range(60, 90))
    assert page(5, 50) == list(range(250, 300))
    assert page(9, 100) == list(range(900, 1000))
    assert page(33, 30) == list(range(990, 1000))
    assert page(40, 30) == []
    assert page(0, None) == list(range(1000))


def test_pages_by_the_last_key(spark):
    rows_ = spark.range(100).select((F.col("id") % 7).alias("a"), F.col("id").alias("b")).repartition(5)
    expected = sorted(((n % 7, n) for n in range(100)), key=lambda row: (-row[0], row[1]))
    order, last, found = [("a", True), ("b", False)], None, []
    while part := serving.page_after(rows_, 30, order, last).collect():
        found += [tuple(row) for row in part]
        last = found[-1]
    assert found == expected


ODD_KEYS = [None, "", "a", "ab", "b", "Z", "é", "๕"]


@pytest.mark.parametrize("case", range(4))
def test_selected_pages_match_a_sort(spark, monkeypatch, case):
    """Few cuts, so that ranges are cut again; ties, NULL, NaN and rows that repeat."""
    monkeypatch.setattr(selection, "TOP_ROWS", 0)
    monkeypatch.setattr(selection, "sample_keys", partial(selection.sample_keys, cuts=(3, 5, 9, 40)[case]))
    rng = random.Random(case)
    pick = [
        lambda: (rng.choice(ODD_KEYS), rng.choice([None, float("nan"), -1.5, 0.0, 2.0]), rng.randint(0, 3)),
        lambda: (str(rng.randint(0, 10**6)), rng.random(), rng.randint(0, 10**9)),
        lambda: ("same", 1.0, 1) if rng.random() < 0.6 else (rng.choice(ODD_KEYS), 1.0, rng.randint(0, 10**6)),
        lambda: (f"{rng.randint(0, 99):02}", float(rng.randint(0, 5)), 7),
    ][case]
    data = [pick() for _ in range(1500)]
    table = spark.createDataFrame(data, "a string, b double, c long").repartition(6).persist()
    order = [[("a", False)], [("b", True), ("a", False)], [("c", False), ("a", True)], [("b", True)]][case]
    full = selection.total_order(table, order)
    expected = [str(tuple(row)) for row in table.orderBy(*selection.sort_columns(full)).collect()]
    for page_no, size in ((0, 10), (3, 7), (20, 30), (49, 30), (50, 30), (2, 400), (0, 1500), (7, 1)):
        found = [str(tuple(row)) for row in serving.page(table, page_no, size, order).collect()]
        assert found == expected[page_no * size : (page_no + 1) * size], (page_no, size)
    assert serving.page(table.limit(0), 1, 30, order).count() == 0
    table.unpersist()


def test_a_deep_page_sorts_a_few_pages_and_writes_nothing(spark):
    skus = spark.range(200_000).select(F.format_string("%08d", F.col("id") * 7919 % 200_000).alias("sku"))
    staging.stage(spark.range(1), "there")
    written = set(os.listdir(f"{staging.staging_root(spark)}/stockweave"))
    page = serving.page(skus, 5000, 30, [("sku", False)])
    assert set(os.listdir(f"{staging.staging_root(spark)}/stockweave")) == written
    assert [int(row.sku) for row in page.collect()] == list(range(150_000, 150_030))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Sort " not in plan and "Exchange" not in plan


def test_what_is_sorted_is_a_few_pages(spark, monkeypatch):
    sorted_rows, top = [], selection._top
    monkeypatch.setattr(selection, "_top", lambda rows, *rest: sorted_rows.append(rows.count()) or top(rows, *rest))
    skus = spark.range(100_000).select(F.format_string("%08d", F.col("id") * 7919 % 100_000).alias("sku"))
    for page_no in (17, 1_000, 3_333):
        serving.page(skus, page_no, 30, [("sku", False)])
    assert sum(sorted_rows) <= 3 * 8 * 30 and sorted_rows


def test_number_rows_descending(spark):
    df = spark.range(500).select((F.col("id") * 7 % 500).alias("n")).repartition(5)
    numbered = serving.number_rows(df, F.col("n").desc())
    assert all(row.row_no == 500 - row.n for row in numbered.collect())
    assert numbered.count() == 500


def test_dashboard(spark, snapshot, folder):
    history.append_snapshots(
        snapshot.withColumn("snapshot_ts", F.lit("2026-01-02 01:00:00").cast("timestamp_ntz")),
        f"{folder}/history",
    )
    opened = dashboard.open_snapshot(spark, folder)
    assert opened.count() == len(ROWS)
    assert dashboard.open_snapshot(spark, folder, "020126_010000.json").count() == len(ROWS)
    view = dashboard.View(branches=["Samyan", "HQ", "Saimai"], order_by="qty", descending=True)
    rows_ = dashboard.totals(opened, view)
    found = [tuple(row) for row in dashboard.table(rows_, view).collect()]
    assert found == [
        ("S2", "Floss", 9.5, "low"), ("S3", "แปรงสีฟัน", 7.0, "low"),
        ("S1", "Brush A", 1.0, "critical"),
    ]
    view = dashboard.View(search="s", order_by="item", page_no=1, size=2)
    rows_ = dashboard.totals(opened, view)
    assert [row.sku for row in dashboard.table(rows_, view).collect()] == ["S3"]
    view = dashboard.View(search="floss")
    assert tuple(dashboard.info(rows_, view).first()) == (3, 1)
    assert dashboard.pages(rows_, view) == {30: 1, 50: 1, 100: 1, None: 1}
    dashboard.export(rows_, f"{folder}/export")
    assert documents.read_export(spark, f"{folder}/export").count() == 3
    with pytest.raises(ValueError, match="no column"):
        dashboard.order_of(dashboard.View(order_by="branch"))


def test_quantity_text(spark):
    qty = [12.0, 12.5, -3.0, 0.0, 0.25]
    df = spark.createDataFrame([(q,) for q in qty], "qty double")
    found = [row[0] for row in df.select(stock.quantity_text(F.col("qty"))).collect()]
    assert found == ["12", "12.5", "-3", "0", "0.25"]
