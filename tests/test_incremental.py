"""Runs that read just what changed, against runs that read everything."""

from __future__ import annotations

import json
import os
import random
import shutil
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from sequential import fold, long_form
from stockweave.operators import reconcile
from stockweave.plans import incremental, nightly
from stockweave.schemas import FEED
from stockweave.sources import feeds, history, state
from test_nightly import STORES, land, put, specs_of
from test_reconcile import random_case

AS_OF = datetime(2026, 1, 1, 18, 26, 37, tzinfo=timezone.utc)
HEAD = "Item,SKU,Available Qty.\n"


def results(spark, root):
    latest = history.latest_snapshot(spark, f"{root}/history").collect()
    reports = [
        sorted(map(str, nightly.read_report(spark, root, name).drop("version").collect()))
        for name in ("rejects", "feed_status")
    ]
    return sorted(map(str, latest)), *reports


def check(spark, folder, specs, number):
    """An incremental run on the state of the earlier ones, and a full one."""
    nightly.run(spark, specs, f"{folder}/kept", AS_OF, incremental=True)
    nightly.run(spark, specs, f"{folder}/full-{number}", AS_OF)
    kept, full = (results(spark, f"{folder}/{name}") for name in ("kept", f"full-{number}"))
    assert kept == full
    return full


@pytest.fixture()
def read(monkeypatch):
    """Names of the files that are read, in lists for each scan."""
    scans, real = [], state.read_files

    def noted(spark, spec, files, layout):
        scans.append([os.path.relpath(file.path.removeprefix("file:"), spec.path) for file in files])
        return real(spark, spec, files, layout)

    monkeypatch.setattr(state, "read_files", noted)
    return scans


def test_a_mended_store_is_read_alone(spark, folder, read):
    landed = f"{folder}/landed"
    land(landed, random.Random(11))
    specs = specs_of(landed)
    first = check(spark, folder, specs, 0)
    assert sorted(name for scan in read for name in scan) == sorted([
        *(f"branch={store}/table.csv" for store in STORES), "products.json", "table.csv", "sheet.csv", "sheet.csv",
    ])
    read.clear()
    put(f"{landed}/pos/branch=Samyan/table.csv", HEAD + "n1,n2,77\nn3,n4,broken\nn5,n6,8\n")
    changed = check(spark, folder, specs, 2)
    assert read == [["branch=Samyan/table.csv"]] and changed != first
    read.clear()
    put(f"{landed}/pos/branch=Samyan/table.csv", HEAD + "n1,n2,77\nn3,n4,1\nn5,n6,8\n")
    put(f"{landed}/vend/table.csv", "R,,,,,,,\n,,,,,,,\n1,2,3,4,5,6,7,8\n,,V1,v,,,,5\n")
    put(f"{landed}/api/more.json", json.dumps({"list": [{"sku": "n1", "availablestock": 99}]}))
    check(spark, folder, specs, 3)
    assert sorted(read) == [["branch=Samyan/table.csv"], ["more.json"], ["table.csv"]]


def test_files_that_go_and_come_back(spark, folder, read):
    landed = f"{folder}/landed"
    land(landed, random.Random(12))
    for n in range(3):
        put(f"{landed}/pos/branch=Rama 9/more{n}.csv", HEAD + f"n{n},n{n + 1},{n}\n")
    specs = specs_of(landed)
    check(spark, folder, specs, 0)
    read.clear()
    shutil.move(f"{landed}/pos/branch=Rama 9/more0.csv", f"{folder}/away.csv")
    check(spark, folder, specs, 1)
    shutil.move(f"{folder}/away.csv", f"{landed}/pos/branch=Rama 9/more0.csv")
    check(spark, folder, specs, 2)
    assert read == []


def test_a_bad_file_ends_its_unit_in_later_files(spark, folder, read):
    """Also if the later files were read long before, and until it is mended."""
    for store in ("A", "B"):
        for n in range(4):
            put(f"{folder}/pos/branch={store}/{n}.csv", HEAD + "".join(f"i{store}{n}{m},s{m},{m}\n" for m in range(3)))
    specs = [feeds.pos_feed(f"{folder}/pos", ("A", "B"))]
    check(spark, folder, specs, 0)
    put(f"{folder}/pos/branch=A/1.csv", HEAD + "x,s1,1\ny,s2,bad\n,s3,3\n")
    snapshot, rejects, _ = check(spark, folder, specs, 1)
    assert sum("after a bad quantity" in line for line in rejects) == 7
    put(f"{folder}/pos/branch=A/0.csv", HEAD + "x,s1,also bad\n")
    check(spark, folder, specs, 2)
    for n in (0, 1):
        put(f"{folder}/pos/branch=A/{n}.csv", HEAD + f"mended{n},s1,1\n")
    _, rejects, _ = check(spark, folder, specs, 3)
    assert rejects == []


def test_wide_rows_and_odd_headers(spark, folder, read):
    put(f"{folder}/pos/branch=A/a.csv", HEAD + "a,S1,1\n")
    put(f"{folder}/pos/branch=B/a.csv", HEAD + "b, really,S2,2\n")
    put(f"{folder}/pos/branch=D/a.csv", "SKU,Stock\nS4,4\n")
    specs = [feeds.pos_feed(f"{folder}/pos", ("A", "B", "C", "D"))]
    _, _, status = check(spark, folder, specs, 0)
    assert sum("failed" in line for line in status) == 3
    put(f"{folder}/pos/branch=B/a.csv", HEAD + '"b, really",S2,2\n')
    put(f"{folder}/pos/branch=C/a.csv", "SKU,Available Qty.,Item\nS3,3,c\n")
    check(spark, folder, specs, 1)
    put(f"{folder}/pos/branch=D/a.csv", HEAD + "d,S4,4\n")
    _, _, status = check(spark, folder, specs, 2)
    assert not any("failed" in line for line in status)


@pytest.mark.parametrize("on_bad", ["prefix", "reject_row"])
def test_rejected_rows(spark, folder, on_bad):
    text = "R,,,,,,,\n,,,,,,,\nn,id,site,sku,a,b,c,left\n1,x,P,V1,,,,5\n,,,,,,,\n2,x,,V2,,,,6\n4,x,P,V4,,,,out\n5,x,P,V5,,,,9\n"
    put(f"{folder}/vend/1.csv", text)
    put(f"{folder}/vend/2.csv", text.replace("out", "7"))
    specs = [feeds.vend_feed(f"{folder}/vend", on_bad=on_bad)]
    check(spark, folder, specs, 0)
    put(f"{folder}/vend/0.csv", text.replace("V", "W"))
    check(spark, folder, specs, 1)


def test_a_failed_run_keeps_what_it_has_read(spark, folder, read):
    landed = f"{folder}/landed"
    land(landed, random.Random(13))
    good = open(f"{landed}/depot/sheet.csv", encoding="utf-8").read()
    put(f"{landed}/depot/sheet.csv", "1,2,3,4,5,6,7\n,s,i,,,,three\n")
    with pytest.raises(Exception, match="not a quantity"):
        nightly.run(spark, specs_of(landed), f"{folder}/kept", AS_OF, incremental=True)
    read.clear()
    put(f"{landed}/depot/sheet.csv", good)
    check(spark, folder, specs_of(landed), 0)
    assert read == [["sheet.csv"]]


def test_another_rule_reads_the_files_again(spark, folder, read):
    put(f"{folder}/pos/branch=A/a.csv", HEAD + "a,S1,1\nb,S2,2.5\nc,S3,3\n")
    for number, cells in enumerate(("numeric", "text", "numeric")):
        check(spark, folder, [feeds.pos_feed(f"{folder}/pos", ("A",), qty_cells=cells)], number)
    assert len(read) == 2


def test_parts_of_random_feeds_merge_to_the_whole(spark):
    """1,500 random feeds, each dealt to files: their digests put together are the whole's."""
    rng = random.Random(17)
    cases = [random_case(case, rng) for case in range(1500)]
    records = [record for case in cases for record in case]
    feed = spark.createDataFrame(records, FEED)
    parts = []
    for number in range(4):  # neighbours lie in one part mostly, as in files
        part = feed.where(F.pmod(F.floor(F.col("ord") / 7), F.lit(4)) == number)
        by_sku = reconcile.item_records(part).groupBy("item", "sku").agg(F.min("ord").alias("ord"), F.min("phase").alias("phase"))
        parts.append((reconcile.digest(part), by_sku))
    digests, firsts = (nightly.union([part[side] for part in parts]) for side in (0, 1))
    done = reconcile.reconcile_reduced(feed, reconcile.merged_digest(digests), reconcile.first_of_items(firsts))
    expected, dropped = [], []
    for case in cases:
        merged, lost = fold(case)
        expected += long_form(merged)
        dropped += lost
    assert sorted(tuple(row) for row in done.snapshot().collect()) == sorted(expected)
    assert sorted(row.ord for row in done.dropped().collect()) == sorted(dropped)


def test_runs_are_the_same_for_random_landings(spark, folder):
    rng = random.Random(19)
    specs = specs_of(f"{folder}/landed")
    for number in range(2):
        land(f"{folder}/landed", random.Random(rng.randint(0, 9)))
        if number == 1:
            put(f"{folder}/landed/pos/branch=Samyan/z.csv", HEAD + "n1,n9,3\nn2,n3,x\nn4,n4,4\n")
        check(spark, folder, specs, number)


def test_names_that_globs_would_read_otherwise(spark, folder):
    names = ("a[1]", "x{y}", "q?", "Rama 9", "50%")
    for name in names:
        escaped = feeds._path_utils(spark).escapePathName(name)
        put(f"{folder}/pos/branch={escaped}/t [1] {{x}}.csv", HEAD + f"i {name},S1,1\n")
    check(spark, folder, [feeds.pos_feed(f"{folder}/pos", names)], 0)


def test_parquet_feeds(spark, folder, read):
    for store, extra in (("A", 1.0), ("B", 2.0)):
        spark.createDataFrame([(f"i{store}", "S1", extra)], "Item string, SKU string, `Available Qty.` double").coalesce(1).write.parquet(
            f"{folder}/pos/branch={store}")
    specs = [feeds.pos_feed(f"{folder}/pos", ("A", "B"), format="parquet")]
    check(spark, folder, specs, 0)
    spark.createDataFrame([("iB", "S2", 5.0)], "Item string, SKU string, `Available Qty.` double").coalesce(1).write.mode(
        "append").parquet(f"{folder}/pos/branch=B")
    read.clear()
    check(spark, folder, specs, 1)
    assert [len(scan) for scan in read] == [1]


def test_a_spec_is_told_once_for_all_its_files(spark, folder, monkeypatch):
    """Telling a spec makes its expression in the JVM: done for each file, it took most of a run's time."""
    for n in range(12):
        put(f"{folder}/depot/sheet={n:02d}/a.csv", f"n,sku,item,a,b,c,left\n,S{n},I{n},,,,{n}\n")
    told, real = [], state.fingerprint
    monkeypatch.setattr(state, "fingerprint", lambda spec: told.append(spec.name) or real(spec))
    spec = feeds.depot_feed(f"{folder}/depot", aliases={})
    for _ in range(2):
        files = feeds.landed_files(spark, spec, [spec.name])
        known = state.known_units(spark, f"{folder}/state", spec, files)
        assert [k.landed for k in known] == files and [k.file for k in known] == list(range(12))
    assert len(told) <= 2 and len({k.load for k in known}) == 1


def test_listings_leave_out_hidden_names_at_any_depth(spark, folder):
    for name in ("b/deep/é 5%25 [a].csv", "a.csv", "b/.c.csv", "_hidden/d.csv", "b/_deep/e.csv", "_SUCCESS"):
        put(f"{folder}/depot/{name}", "n\n")
    put(f"{folder}/empty.csv", "")
    found = feeds.landed_files(spark, feeds.depot_feed(f"{folder}/depot"), ["depot"])
    assert [(f.path.removeprefix(f"file:{folder}/depot/"), f.size) for f in found] == [
        ("a.csv", 2), ("b/deep/é 5%25 [a].csv", 2)]
    assert found[1].uri.endswith("/b/deep/%C3%A9%205%2525%20%5Ba%5D.csv") or found[1].uri.endswith("/b/deep/é%205%2525%20%5Ba%5D.csv")
    (single,) = feeds.landed_files(spark, feeds.depot_feed(f"{folder}/empty.csv"), ["depot"])
    assert single.size == 0
