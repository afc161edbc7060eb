from __future__ import annotations

import json
import math
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stockweave.functions import naming
from stockweave.operators import reconcile
from stockweave.plans.nightly import run
from stockweave.schemas import SNAPSHOT
from stockweave.sources import documents, feeds, history

ROWS = [
    ("007", "แปรงสีฟัน", "Samyan", 4.0, 1),
    ("007", "แปรงสีฟัน", "HQ", 2.5, 1),
    ("S2", 'say "hi", ok', "On Time", -1.0, 2),
]


def append(spark, root, rows, ts):
    stamped = spark.createDataFrame(rows, SNAPSHOT).withColumn(
        "snapshot_ts", F.lit(ts).cast("timestamp_ntz")
    )
    history.append_snapshots(stamped, root)


def plain(df):
    return sorted(tuple(row) for row in df.select(*SNAPSHOT.names).collect())


def catalog_names(spark, root):
    return [r.file_name for r in history.catalog(history.snapshot_ids(spark, root)).collect()]


def test_append_replace_and_read(spark, folder):
    root = f"{folder}/history"
    append(spark, root, ROWS, "2026-01-02 01:26:37")
    append(spark, root, ROWS[:1], "2026-02-01 01:00:00")
    append(spark, root, ROWS[:2], "2025-12-31 02:00:00")
    assert catalog_names(spark, root) == [
        "010226_010000.json", "020126_012637.json", "311225_020000.json",
    ]
    assert plain(history.latest_snapshot(spark, root)) == sorted(ROWS[:1])
    assert plain(history.snapshot_at(spark, root, "020126_012637.json")) == sorted(ROWS)
    assert plain(history.snapshot_at(spark, root, "311225_020000")) == sorted(ROWS[:2])
    append(spark, root, ROWS[2:], "2026-01-02 01:26:37")
    assert plain(history.snapshot_at(spark, root, "020126_012637")) == sorted(ROWS[2:])
    assert len(catalog_names(spark, root)) == 3
    assert history.snapshot_at(spark, root, "050505_050505").count() == 0


def test_a_failed_append_keeps_the_old_rows(spark, folder):
    root = f"{folder}/history"
    append(spark, root, ROWS, "2026-01-02 01:26:37")
    broken = spark.createDataFrame(ROWS, SNAPSHOT).withColumn(
        "qty", F.raise_error(F.lit("broken")).cast("double")
    ).withColumn("snapshot_ts", F.lit("2026-01-02 01:26:37").cast("timestamp_ntz"))
    with pytest.raises(Exception, match="broken"):
        history.append_snapshots(broken, root)
    assert plain(history.latest_snapshot(spark, root)) == sorted(ROWS)


def test_history_prunes_to_one_partition(spark, folder):
    root = f"{folder}/history"
    for day in range(1, 6):
        append(spark, root, ROWS, f"2026-01-0{day} 01:00:00")
    one = history.snapshot_at(spark, root, "030126_010000").where(F.col("branch").isin("HQ", "X"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "In(branch, [HQ,X])" in plan
    assert all("snapshot_id=030126_010000" in path for path in one.inputFiles())
    assert len({row[0] for row in one.select("_metadata.file_path").collect()}) == 1


def test_no_history(spark, folder):
    assert catalog_names(spark, f"{folder}/none") == []
    assert history.latest_snapshot(spark, f"{folder}/none").count() == 0


def test_catalog_of_a_folder(spark, folder):
    for name in ("020126_012637.json", "010226_000000.json", "bad.json", "file_list.json",
                 "note.txt", "010169_000000.json"):
        with open(os.path.join(folder, name), "w", encoding="utf-8") as file:
            file.write("{}")
    names = history.file_names(spark, folder)
    listed = history.catalog(names).collect()
    assert [row.file_name for row in listed] == [
        "010169_000000.json", "010226_000000.json", "020126_012637.json",
    ]
    assert listed[0].snapshot_ts == datetime(2069, 1, 1)
    assert listed[2].snapshot_ts == datetime(2026, 1, 2, 1, 26, 37)
    assert [row.file_name for row in history.malformed_names(names).collect()] == ["bad.json"]
    assert history.snapshot_count(history.catalog(names)).first().snapshots == 3
    labels = [row.label for row in history.with_labels(history.catalog(names)).collect()]
    assert labels[2] == "วันที่ 02/01/2026 01:26:37"
    shown = history.with_last_updated(history.catalog(names)).collect()
    assert shown[2].last_updated == "2026-01-02 01:26:37"


@pytest.mark.parametrize("indent", [None, 4])
def test_index_file(spark, folder, indent):
    names = ["311225_020000.json", "020126_012637.json", "010226_010000.json"]
    listed = history.catalog(spark.createDataFrame([(n,) for n in names], "file_name string"))
    history.write_index(listed, f"{folder}/index", indent)
    text = spark.read.text(f"{folder}/index", wholetext=True).first().value.rstrip("\n")
    newest_first = [names[2], names[1], names[0]]
    separators = (",", ":") if indent is None else None
    assert text == json.dumps(newest_first, indent=indent, separators=separators)
    found = history.read_index(spark, f"{folder}/index").collect()
    assert [row.file_name for row in found] == newest_first


def test_a_failed_index_leaves_the_old_one(spark, folder):
    listed = history.catalog(spark.createDataFrame([("020126_012637.json",)], "file_name string"))
    history.write_index(listed, f"{folder}/index")
    broken = listed.withColumn("file_name", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        history.write_index(broken, f"{folder}/index")
    found = history.read_index(spark, f"{folder}/index").collect()
    assert [row.file_name for row in found] == ["020126_012637.json"]
    history.write_index(listed.limit(0), f"{folder}/index")
    assert history.read_index(spark, f"{folder}/index").count() == 0


def test_empty_snapshots_are_listed_and_replace(spark, folder):
    root = f"{folder}/history"
    append(spark, root, ROWS, "2026-01-02 01:26:37")
    for day in ("2026-01-02 01:26:37", "2026-01-03 01:00:00"):
        stamps = spark.range(1).select(F.lit(day).cast("timestamp_ntz").alias("snapshot_ts"))
        nothing = spark.createDataFrame([], SNAPSHOT).crossJoin(stamps)
        history.append_snapshots(nothing, root, stamps)
    assert catalog_names(spark, root) == ["030126_010000.json", "020126_012637.json"]
    for name in catalog_names(spark, root):
        assert history.snapshot_at(spark, root, name).count() == 0
    assert history.read_history(spark, root).count() == 0


def test_broken_documents_fail(spark, folder):
    good = json.dumps({"last_updated": "t", "inventory": []})
    with open(f"{folder}/020126_012637.json", "w", encoding="utf-8") as file:
        file.write(good + "\n" + good[:30] + "\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        documents.read_documents(spark, folder)


def test_missing_parts_fail(spark, folder):
    rows = [(f"S{n:03}", "i", "HQ", 1.0, n) for n in range(25)]
    path = f"{folder}/documents"
    documents.write_documents(spark.createDataFrame(rows, SNAPSHOT), path, F.lit("t"), 10)
    lines = [json.loads(row.value) for row in spark.read.text(path).collect()]
    assert sorted((line["part"], line["parts"]) for line in lines) == [(1, 3), (2, 3), (3, 3)]
    os.makedirs(f"{folder}/cut")
    with open(f"{folder}/cut/a.json", "w", encoding="utf-8") as file:
        file.writelines(json.dumps(line) + "\n" for line in lines if line["part"] != 2)
    with pytest.raises(documents.IncompleteSnapshot, match="2 of 3"):
        documents.read_documents(spark, f"{folder}/cut")


def test_quantities_as_text_count_as_far_as_they_are_numbers(spark, folder):
    branch = {"a": "12", "b": "12abc", "c": " -3.5 ", "d": 7, "e": "x", "f": "", "g": "1e2kg", "h": ".5"}
    branch |= {"i": "+4", "j": "\n8", "k": "1.2.3"}
    document = {"last_updated": "t", "inventory": [{"Item": "i", "SKU": "S", "Branch": branch}]}
    with open(f"{folder}/020126_012637.json", "w", encoding="utf-8") as file:
        json.dump(document, file)
    rows = reconcile.explode_branches(documents.read_documents(spark, folder)).collect()
    found = {row.branch: row.qty for row in rows}
    assert all(math.isnan(found.pop(name)) for name in "ef")
    assert found == {"a": 12, "b": 12, "c": -3.5, "d": 7, "g": 100, "h": 0.5, "i": 4, "j": 8, "k": 1.2}


def test_import_of_old_documents(spark, folder):
    os.makedirs(f"{folder}/old")
    for name, skus in (("020126_012637", 2), ("030126_010000", 0), ("bad", 1), ("file_list", 0)):
        inventory = [{"Item": f"i{n}", "SKU": f"S{n}", "Branch": {"HQ": n, "B": "2"}} for n in range(skus)]
        text = {"last_updated": "t", "inventory": inventory} if name != "file_list" else ["x"]
        with open(f"{folder}/old/{name}.json", "w", encoding="utf-8") as file:
            json.dump(text, file, indent=1)
    os.remove(f"{folder}/old/file_list.json")
    documents.import_documents(spark, f"{folder}/old", f"{folder}/history")
    assert catalog_names(spark, f"{folder}/history") == ["030126_010000.json", "020126_012637.json"]
    rows = history.snapshot_at(spark, f"{folder}/history", "020126_012637").collect()
    assert sorted((r.sku, r.item, r.branch, r.qty, r.entry_ord & 0xFFFF) for r in rows) == [
        ("S0", "i0", "B", 2.0, 0), ("S0", "i0", "HQ", 0.0, 0), ("S1", "i1", "B", 2.0, 1), ("S1", "i1", "HQ", 1.0, 1),
    ]
    assert history.snapshot_at(spark, f"{folder}/history", "030126_010000").count() == 0


def test_documents(spark, folder):
    rows = [(f"S{n:03}", f"item {n}", b, n / 2, n) for n in range(50) for b in ("HQ", "Mega")]
    rows += [("007", "แปรงสีฟัน", "Rama 9", 3.0, 99)]
    snapshot = spark.createDataFrame(rows, SNAPSHOT)
    path = f"{folder}/documents"
    documents.write_documents(snapshot, path, F.lit("2026-01-02 01:26:37"), 20)
    read = documents.read_documents(spark, path)
    assert {row.last_updated for row in read.select("last_updated").collect()} == {
        "2026-01-02 01:26:37"
    }
    back = reconcile.explode_branches(read)
    assert sorted(map(tuple, back.collect())) == sorted(row[:4] for row in rows)
    lines = [json.loads(row.value) for row in spark.read.text(path).collect()]
    assert sorted(len(line["inventory"]) for line in lines) == [11, 20, 20]
    for line in lines:
        order = [entry["SKU"] for entry in line["inventory"]]
        assert order == sorted(order, key=lambda sku: (sku == "007", sku))
    raw = "".join(row.value for row in spark.read.text(path).collect())
    assert "แปรงสีฟัน" in raw


def test_documents_of_old_snapshots(spark, folder):
    document = {"last_updated": "2026-01-02 01:26:37", "inventory": [
        {"Item": "a", "SKU": "S1", "Branch": {"HQ": 12, "On Time": 12.5}},
        {"Item": "b", "SKU": "S2", "Branch": {}},
    ]}
    with open(f"{folder}/020126_012637.json", "w", encoding="utf-8") as file:
        json.dump(document, file, indent=2)
    read = documents.read_documents(spark, f"{folder}/020126_012637.json", multi_line=True)
    assert sorted(map(tuple, reconcile.explode_branches(read).collect())) == [
        ("S1", "a", "HQ", 12.0), ("S1", "a", "On Time", 12.5),
    ]


def test_export_keeps_skus_as_text(spark, folder):
    totals = spark.createDataFrame(
        [("007", 'say "hi", ok', 1.5), ("1e3", "แปรง", -2.0)], "sku string, item string, qty double"
    )
    documents.write_export(totals, f"{folder}/export")
    back = documents.read_export(spark, f"{folder}/export")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, totals.collect()))
    header = spark.read.text(f"{folder}/export").where("value like 'SKU%'").first()
    assert header.value == "SKU,Item,Qty"


def test_times(spark):
    one = spark.range(1).select(
        naming.last_updated_text(F.lit("2026-01-01 18:26:37").cast("timestamp_ntz")),
        naming.file_name(F.lit("2026-01-02 01:26:37").cast("timestamp_ntz")),
        naming.snapshot_ts(F.lit("020126_012637.json")),
        naming.snapshot_ts(F.lit("320126_012637.json")),
    ).first()
    assert tuple(one) == (
        "2026-01-02 01:26:37", "020126_012637.json", datetime(2026, 1, 2, 1, 26, 37), None,
    )


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Bangkok"])
def test_names_and_times_do_not_depend_on_the_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        days = ("2026-03-08", "2026-11-01")  # the clocks change in New York
        times = [f"{day} 0{hour}:{minute}:07" for day in days for hour in range(1, 5) for minute in ("00", "30", "59")]
        frame = spark.createDataFrame([(t,) for t in times], "t string")
        ts = F.col("t").cast("timestamp_ntz")
        rows = frame.select(
            "t", naming.snapshot_name(ts).alias("name"), naming.snapshot_label(ts).alias("label"),
            naming.time_text(naming.snapshot_ts(naming.file_name(ts))).alias("back"),
            naming.last_updated_text(ts).alias("shop"),
        ).collect()
        for row in rows:
            when = datetime.fromisoformat(row.t)
            assert row.name == when.strftime("%d%m%y_%H%M%S")
            assert row.label == when.strftime("วันที่ %d/%m/%Y %H:%M:%S")
            assert row.back == row.t
            assert row.shop == (when + timedelta(hours=7)).strftime("%Y-%m-%d %H:%M:%S")
        bad = ("", "x", "020126", "020126_0126371", "300226_000000", "020126_250000", "0a0126_000000")
        names = spark.createDataFrame([(name,) for name in bad], "n string")
        assert names.where(naming.snapshot_ts(F.col("n")).isNotNull()).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_snapshot_name_is_the_shop_clock(spark, folder):
    with open(f"{folder}/hq.csv", "w", encoding="utf-8") as file:
        file.write("1,2,3,4,5,6,7,8\n,,,,,,,\n,,x,,,,,\n,,S1,i,,,,3\n")
    when = datetime.fromisoformat("2026-01-02T00:30:00+09:00")
    run(spark, [feeds.hq_feed(f"{folder}/hq.csv")], f"{folder}/out", when)
    assert catalog_names(spark, f"{folder}/out/history") == ["010126_223000.json"]
