"""Landed files, written here as text and read with the real readers."""

from __future__ import annotations

import json
import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stockweave.functions.ordinal import ordinal
from stockweave.plans import nightly
from stockweave.plans.nightly import read_feeds
from stockweave.sources import feeds


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as file:
        file.write(text)
    return path


def records(clean):
    return [
        (row.item, row.sku, row.branch, row.qty)
        for row in clean.records.orderBy("ord").collect()
    ]


def rejects(clean):
    return sorted(
        ((row.sku, row.reason) for row in clean.rejects.collect()), key=lambda r: (r[0] is None, r)
    )


def statuses(clean):
    return {row.unit: (row.status, row.n_rows) for row in clean.status.collect()}


def test_stores(spark, folder):
    put(folder, "branch=Rama 9/a.csv",
        'No,Item,SKU,Available Qty.,Note\n1,แปรงสีฟัน,00123,4,x\n2,"Brush, soft",S2,2.9,\n')
    put(folder, "branch=Samyan/a.csv", "No,Item,SKU,Available Qty.,Note\n1,Floss,S3,-1,\n")
    clean = read_feeds(spark, [feeds.pos_feed(folder, ("Samyan", "Rama 9", "Mega"))])
    assert records(clean) == [
        ("Floss", "S3", "Samyan", -1.0),
        ("แปรงสีฟัน", "00123", "Rama 9", 4.0),
        ("Brush, soft", "S2", "Rama 9", 2.0),
    ]
    assert statuses(clean) == {
        "Samyan": ("read", 1), "Rama 9": ("read", 2), "Mega": ("failed", 0),
    }


def test_cell_with_line_break(spark, folder):
    put(folder, "branch=A/a.csv", 'Item,SKU,Available Qty.\n"two\nlines ""x""",S1,1\nb,S2,2\n')
    clean = read_feeds(spark, [feeds.pos_feed(folder, ("A",), multi_line=True)])
    assert records(clean) == [('two\nlines "x"', "S1", "A", 1.0), ("b", "S2", "A", 2.0)]


def test_bad_quantity_ends_its_store_only(spark, folder):
    head = "Item,SKU,Available Qty.\n"
    put(folder, "branch=A/a.csv", head + "a,S1,1\nb,S2,\nc,S3,3\n")
    put(folder, "branch=B/a.csv", head + "a,S1,5\n,S2,6\nc,S3,7\n")
    clean = read_feeds(spark, [feeds.pos_feed(folder, ("A", "B"))])
    assert records(clean) == [("a", "S1", "A", 1.0), ("a", "S1", "B", 5.0), ("c", "S3", "B", 7.0)]
    assert rejects(clean) == [
        ("S2", "bad quantity"), ("S2", "no item or SKU"), ("S3", "after a bad quantity"),
    ]
    kept = read_feeds(spark, [feeds.pos_feed(folder, ("A", "B"), on_bad="reject_row")])
    assert ("c", "S3", "A", 3.0) in records(kept)
    assert rejects(kept) == [("S2", "bad quantity"), ("S2", "no item or SKU")]


def test_text_cells_are_stricter(spark, folder):
    put(folder, "branch=A/a.csv", "Item,SKU,Available Qty.\na,S1,5\nb,S2,5.0\n")
    assert len(records(read_feeds(spark, [feeds.pos_feed(folder, ("A",))]))) == 2
    text = read_feeds(spark, [feeds.pos_feed(folder, ("A",), qty_cells="text")])
    assert records(text) == [("a", "S1", "A", 5.0)]


def test_store_without_a_column_is_lost(spark, folder):
    put(folder, "branch=A/a.csv", "Item,SKU,Available Qty.\na,S1,1\n")
    put(folder, "branch=B/a.csv", "Item,SKU,Stock\nb,S2,2\n")
    put(folder, "branch=C/a.csv", "SKU,Available Qty.,Item\nS3,3,c\n")
    clean = read_feeds(spark, [feeds.pos_feed(folder, ("A", "B", "C"))])
    assert records(clean) == [("a", "S1", "A", 1.0), ("c", "S3", "C", 3.0)]
    assert statuses(clean) == {"A": ("read", 1), "B": ("failed", 0), "C": ("read", 1)}


def test_a_store_with_fewer_columns_is_lost_alone(spark, folder):
    put(folder, "branch=A/a.csv", "Item,SKU,Available Qty.\na,S1,1\n")
    put(folder, "branch=B/a.csv", "SKU,Stock\nS2,2\n")
    clean = read_feeds(spark, [feeds.pos_feed(folder, ("A", "B"))])
    assert records(clean) == [("a", "S1", "A", 1.0)]
    assert statuses(clean) == {"A": ("read", 1), "B": ("failed", 0)}


def test_order_follows_the_file_however_it_is_split(spark, folder):
    lines = "".join(f"item {n},S{n},{n}\n" for n in range(5000))
    for name in ("a", "b"):
        put(folder, f"branch=A/{name}.csv", "Item,SKU,Available Qty.\n" + lines)
    seen = []
    for size, multi_line in (("134217728", True), ("20000", False), ("7777", False)):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        try:
            spec = feeds.pos_feed(folder, ("A",), multi_line=multi_line)
            seen.append(records(read_feeds(spark, [spec])))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    expected = [(f"item {n}", f"S{n}", "A", float(n)) for n in range(5000)] * 2
    assert seen == [expected] * 3


def test_parquet_stores(spark, folder):
    for store, first in (("A", 0), ("7", 3)):
        os.makedirs(f"{folder}/branch={store}")
        pq.write_table(pa.table({
            "Item": [f"i{n}" for n in range(first, first + 3)],
            "SKU": pa.array([first, first + 1, first + 2], pa.int64()),
            "Available Qty.": pa.array([1.9, None, 3.0], pa.float64()),
        }), f"{folder}/branch={store}/part.parquet")
    clean = read_feeds(spark, [feeds.pos_feed(folder, ("7", "A"), format="parquet")])
    assert records(clean) == [("i3", "3", "7", 1.0), ("i0", "0", "A", 1.0)]


def test_bulk_landings_as_parquet(spark, folder):
    os.makedirs(f"{folder}/api")
    pq.write_table(pa.table({"sku": ["P1", "P2"], "availablestock": [1.25, -2.0]}),
                   f"{folder}/api/p.parquet")
    os.makedirs(f"{folder}/hq")
    pq.write_table(
        pa.table({f"c{n}": pa.array(["x", "y"]) if n < 7 else pa.array([3, 0]) for n in range(8)}),
        f"{folder}/hq/p.parquet",
    )
    clean = read_feeds(spark, [
        feeds.api_feed(f"{folder}/api", format="parquet"),
        feeds.hq_feed(f"{folder}/hq", format="parquet", skip_rows=0),
    ])
    assert records(clean) == [
        (None, "P1", "On Time", 1.25), (None, "P2", "On Time", -2.0), ("x", "x", "HQ", 3.0),
    ]


def test_product_list(spark, folder):
    listed = [{"sku": "P1", "availablestock": "1.5", "name": "x"},
              {"sku": "P2", "availablestock": 7}, {"availablestock": 1}]
    put(folder, "p1.json", json.dumps({"list": listed, "count": 3}, indent=2))
    put(folder, "p2.json", json.dumps({"res": "nothing"}))
    clean = read_feeds(spark, [feeds.api_feed(folder)])
    assert records(clean) == [(None, "P1", "On Time", 1.5), (None, "P2", "On Time", 7.0)]
    assert rejects(clean) == [(None, "no item or SKU")]


def test_product_list_with_a_bad_quantity_fails(spark, folder):
    put(folder, "p.json", json.dumps({"list": [{"sku": "P1", "availablestock": "many"}]}))
    with pytest.raises(Exception, match="not a quantity"):
        read_feeds(spark, [feeds.api_feed(folder)])


def test_vending(spark, folder):
    put(folder, "v.csv", "Report,,,,,,,\n,,,,,,,\nn,id,site,sku,a,b,c,left\n"
                         "1,x,T One Building,V1,,,,5\n,,,,,,,\n2,x,,V2,,,,6\n"
                         "3,x,Park,V3,,,,7.8\n4,x,Park,V4,,,,out\n5,x,Park,V5,,,,9\n")
    clean = read_feeds(spark, [feeds.vend_feed(folder)])
    assert records(clean) == [(None, "V1", "T One Building", 5.0), (None, "V3", "Park", 7.0)]
    assert rejects(clean) == [
        ("V2", "no item or SKU"), ("V4", "bad quantity"), ("V5", "after a bad quantity"),
    ]


def test_head_office(spark, folder):
    rows = [("S1", "a", "5"), ("S2", "b", "0.5"), ("S3", "c", "1,234"), ("S4", "d", "-3"),
            ("NA", "e", "4"), ("S6", "", "4"), ("S7", "g", "2.9"), ("S8", "h", " 5 ")]
    text = "A,B,Code,Name,C,D,E,Left\n" + ",,group,,,,,9\n" * 2
    put(folder, "hq.csv", text + "".join(f",,{s},{i},,,,\"{q}\"\n" for s, i, q in rows))
    clean = read_feeds(spark, [feeds.hq_feed(folder)])
    assert records(clean) == [
        ("a", "S1", "HQ", 5.0), ("g", "S7", "HQ", 2.0), ("h", "S8", "HQ", 5.0),
    ]
    assert rejects(clean) == [("S6", "no item or SKU"), (None, "no item or SKU")]


def test_depot(spark, folder):
    put(folder, "d.csv", ",Code,Code,a,,a.b,Left\n1,EW-VSD,a,,,,0\n2,Other,b,,,,-2\n")
    clean = read_feeds(spark, [feeds.depot_feed(folder)])
    assert records(clean) == [("a", "P_EW-US", "Saimai", 0.0), ("b", "Other", "Saimai", -2.0)]


def test_sheets_may_name_their_columns_at_will(spark, folder):
    put(folder, "1.csv", "n,Code,Name,a,b,c,Left on Monday\n1,x,a,,,,1\n")
    put(folder, "2.csv", "n,Code,Name,a,b,c,Left on Tuesday\n1,y,b,,,,2\n")
    clean = read_feeds(spark, [feeds.depot_feed(folder)])
    assert records(clean) == [("a", "x", "Saimai", 1.0), ("b", "y", "Saimai", 2.0)]


def test_long_lists_of_files_need_no_broadcast(spark, folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n in range(5):
            put(folder, f"{n}.csv", f"n,Code,Name,a,b,c,Left\n1,x,i{n},,,,{n}\n")
        clean = read_feeds(spark, [feeds.depot_feed(folder)])
        assert [row[0] for row in records(clean)] == [f"i{n}" for n in range(5)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_required_feeds(spark, folder):
    with pytest.raises(feeds.FeedError):
        read_feeds(spark, [feeds.depot_feed(f"{folder}/none")])
    put(folder, "d.csv", "n,Code,Name,a,b,c,Left\n1,x,a,,,,\n")
    with pytest.raises(Exception, match="not a quantity"):
        read_feeds(spark, [feeds.depot_feed(folder)])
    put(folder, "narrow/d.csv", "n,Code\n1,x\n")
    with pytest.raises(feeds.FeedError, match="position"):
        read_feeds(spark, [feeds.depot_feed(f"{folder}/narrow")])


def test_optional_feeds(spark, folder):
    clean = read_feeds(spark, [feeds.vend_feed(f"{folder}/none"), feeds.pos_feed(folder, ("A",))])
    assert records(clean) == []
    assert statuses(clean) == {"A": ("failed", 0), "vend": ("failed", 0)}


def test_ordinals_are_unique_and_ordered_by_phase(spark, folder):
    for store in ("A", "B"):
        for name in ("1", "2"):
            put(folder, f"pos/branch={store}/{name}.csv",
                "Item,SKU,Available Qty.\n" + "".join(f"{store}{name}{n},s,1\n" for n in range(9)))
    put(folder, "api/p.json", json.dumps({"list": [{"sku": "x", "availablestock": 1}] * 4}))
    specs = [feeds.api_feed(f"{folder}/api"), feeds.pos_feed(f"{folder}/pos", ("B", "A"))]
    rows = read_feeds(spark, specs).records.orderBy("ord").collect()
    assert len({row.ord for row in rows}) == len(rows) == 40
    expected = [f"{store}{name}{n}" for store in "BA" for name in "12" for n in range(9)]
    assert [row.item for row in rows] == expected + [None] * 4


def test_skip_leading_rows_of_units(spark):
    """However far apart the ordinals are, and with fewer rows than are to be skipped."""
    from stockweave.operators.projection import leading_cuts, skip_leading

    rng = random.Random(3)
    units = {unit: sorted(rng.sample(range(10_000), size)) for unit, size in enumerate((1, 2, 3, 4, 40))}
    rows = [(unit, ord_) for unit, ords in units.items() for ord_ in ords]
    table = spark.createDataFrame(rows, "unit int, ord long").repartition(7)
    for n in (1, 2, 3, 7):
        cuts = leading_cuts(table, F.lit(n), "ord", "unit")
        kept = skip_leading(table, cuts, "ord", "unit").collect()
        assert sorted(map(tuple, kept)) == [(unit, ord_) for unit, ords in units.items() for ord_ in ords[n:]]
    by_unit = leading_cuts(table, F.col("unit"), "ord", "unit")
    assert {row._unit: row._cut for row in by_unit.collect()} == {u: o[min(u, len(o)) - 1] for u, o in units.items() if u}


@pytest.mark.parametrize("size", [40, 7])
def test_leading_rows_in_several_blocks(spark, folder, size):
    """Splits of a few bytes, each with a row or none."""
    rows = "".join(f"{n},x,Park,V{n},,,,{n}\n" for n in range(1, 30))
    put(folder, "v.csv", "A long title of the report,,,,,,,\nand another,,,,,,,\nn,id,site,sku,a,b,c,left\n" + rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = records(read_feeds(spark, [feeds.vend_feed(folder)]))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found == [(None, f"V{n}", "Park", float(n)) for n in range(1, 30)]


WIDE = "A,B,Code,Name,C,D,E,Left\n,,S0,z,,,,1\n,,S1,a,x, y,,,7\n,,S2,b,,,,3\n"


def test_a_wide_row_ends_a_required_feed(spark, folder):
    put(folder, "hq.csv", WIDE)
    with pytest.raises(feeds.FeedError, match="more cells than the header"):
        read_feeds(spark, [feeds.hq_feed(folder, skip_rows=0)])


def test_a_wide_row_fails_its_store_only(spark, folder):
    head = "Item,SKU,Available Qty.\n"
    put(folder, "branch=A/a.csv", head + "a,S1,1\nb, really,S2,2\n")
    put(folder, "branch=B/a.csv", head + 'a,S1,5\n"b, ""quoted""",S2,6\nc,S3\n')
    clean = read_feeds(spark, [feeds.pos_feed(folder, ("A", "B"))])
    assert records(clean) == [("a", "S1", "B", 5.0), ('b, "quoted"', "S2", "B", 6.0)]
    assert [(r.unit, r.status) for r in clean.status.orderBy("unit").collect()] == [
        ("A", "failed"), ("B", "read"),
    ]
    assert rejects(clean) == [("S3", "bad quantity")]  # a short row lacks its last cells


def test_a_wide_row_is_rejected_singly_where_bad_rows_are(spark, folder):
    put(folder, "hq.csv", WIDE)
    clean = read_feeds(spark, [feeds.hq_feed(folder, skip_rows=0, on_bad="reject_row")])
    assert records(clean) == [("z", "S0", "HQ", 1.0), ("b", "S2", "HQ", 3.0)]
    assert rejects(clean) == [("S1", "a row with more cells than the header")]


@pytest.mark.parametrize("multi_line", [True, False])
def test_quoted_commas_and_trailing_empty_cells(spark, folder, multi_line):
    put(folder, "branch=A/a.csv", 'Item,SKU,Available Qty.\n"a,""b"",c",S1,1\n')
    put(folder, "branch=B/a.csv", "Item,SKU,Available Qty.\nb,S2,2,\n")
    clean = read_feeds(spark, [feeds.pos_feed(folder, ("A", "B"), multi_line=multi_line)])
    assert records(clean) == [('a,"b",c', "S1", "A", 1.0)]


def test_store_names_with_characters_that_paths_escape(spark, folder):
    names = ("A:B", "50% off", "x=y", "a[1]", "Rama 9")
    rows = [(n, name, f"i{n}", f"S{n}", float(n)) for n, name in enumerate(names)]
    frame = spark.createDataFrame(rows, "n int, branch string, Item string, SKU string, qty double")
    frame.select("branch", "Item", "SKU", F.col("qty").alias("Available Qty.")).write.partitionBy(
        "branch").option("header", True).csv(f"{folder}/pos")
    clean = read_feeds(spark, [feeds.pos_feed(f"{folder}/pos", (*names, "none"))])
    assert records(clean) == [(f"i{n}", f"S{n}", name, float(n)) for n, name in enumerate(names)]
    assert {unit for unit, (status, _) in statuses(clean).items() if status == "failed"} == {"none"}


def test_errors_of_the_cluster_are_not_a_feeds_fault(spark, folder, monkeypatch):
    put(folder, "branch=A/a.csv", "Item,SKU,Available Qty.\na,S1,1\n")

    def lost(*_):
        raise PySparkException("Job aborted due to stage failure: executor lost")

    monkeypatch.setattr(nightly, "read_units", lost)
    with pytest.raises(PySparkException, match="executor lost"):
        read_feeds(spark, [feeds.pos_feed(folder, ("A",))])
    assert not feeds.is_file_fault(PySparkException("Permission denied"))
    assert feeds.is_file_fault(PySparkException("[MALFORMED_RECORD_IN_PARSING] ..."))


def test_ordinals_of_many_files_and_large_positions(spark):
    files = 3 << 20
    places = [(0, 0), (0, (1 << 37) - 1), (1, 0), (files - 2, 5), (files - 1, 0), (files - 1, 1 << 37)]
    rows = spark.createDataFrame([(n, f, p) for n, (f, p) in enumerate(places)], "n int, f long, p long")
    made = [
        row.n for phase in (1, 5) for row in
        rows.withColumn("ord", ordinal(phase, F.col("f"), F.col("p"), files)).orderBy("ord").collect()
    ]
    assert made == list(range(len(places))) * 2
    last = rows.select(F.max(ordinal(1, F.col("f"), F.col("p"), files))).first()[0]
    assert last < rows.select(F.min(ordinal(2, F.col("f"), F.col("p"), files))).first()[0]
    with pytest.raises(Exception, match="do not fit"):
        rows.select(ordinal(1, F.col("f"), F.lit(1 << 40), files)).collect()
