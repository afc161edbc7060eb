from __future__ import annotations

import json
import os
import random
from datetime import datetime, timedelta, timezone

import pytest

from sequential import fold, long_form
from stockweave.operators import reconcile
from stockweave.plans import nightly
from stockweave.sources import feeds, history, staging

AS_OF = datetime(2026, 1, 1, 18, 26, 37, tzinfo=timezone.utc)  # 01:26:37 on the next day there
STORES = ("Samyan", "Rama 9")


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as file:
        file.write(text)


def land(folder, rng):
    """Five random feeds as files; answers the records they stand for."""
    names = [f"n{n}" for n in range(12)]
    records, ord_ = [], 0

    def record(phase, item, sku, branch, qty):
        nonlocal ord_
        ord_ += 1
        records.append((phase, ord_, item, sku, branch, float(qty)))

    for store in STORES:
        text = "Item,SKU,Available Qty.\n"
        for _ in range(15):
            item, sku, qty = rng.choice(names), rng.choice(names), rng.randint(-2, 30)
            text += f"{item},{sku},{qty}\n"
            record(1, item, sku, store, qty)
        put(f"{folder}/pos/branch={store}/table.csv", text)
    products = []
    for _ in range(10):
        sku, qty = rng.choice(names), rng.randint(0, 60) / 4
        products.append({"sku": sku, "availablestock": qty})
        record(2, None, sku, "On Time", qty)
    put(f"{folder}/api/products.json", json.dumps({"list": products}))
    text = "Report,,,,,,,\n,,,,,,,\n1,2,3,4,5,6,7,8\n"
    for _ in range(10):
        sku, branch, qty = rng.choice(names), rng.choice(("V1", "V2")), rng.randint(0, 9)
        text += f",,{branch},{sku},,,,{qty}\n"
        record(3, None, sku, branch, qty)
    put(f"{folder}/vend/table.csv", text)
    text = "1,2,3,4,5,6,7,8\n" + ",,x,x,,,,5\n" * 2
    for _ in range(10):
        item, sku, qty = rng.choice(names), rng.choice(names), rng.randint(-5, 9)
        text += f",,{sku},{item},,,,{qty}\n"
        if qty > 0:
            record(4, item, sku, "HQ", qty)
    put(f"{folder}/hq/sheet.csv", text)
    text = "1,2,3,4,5,6,7\n"
    for _ in range(10):
        item, sku, qty = rng.choice(names), rng.choice(names), rng.randint(-5, 9)
        text += f",{sku},{item},,,,{qty}\n"
        record(5, item, {"n1": "n2"}.get(sku, sku), "Saimai", qty)
    put(f"{folder}/depot/sheet.csv", text)
    return records


def specs_of(folder):
    return [
        feeds.pos_feed(f"{folder}/pos", STORES),
        feeds.api_feed(f"{folder}/api"),
        feeds.vend_feed(f"{folder}/vend"),
        feeds.hq_feed(f"{folder}/hq"),
        feeds.depot_feed(f"{folder}/depot", aliases={"n1": "n2"}),
    ]


def names(spark, root):
    return [row.file_name for row in history.read_index(spark, f"{root}/index").collect()]


@pytest.mark.parametrize("seed", [1, 2])
def test_run_matches_the_rules(spark, folder, seed):
    records = land(f"{folder}/landed", random.Random(seed))
    root = f"{folder}/out"
    nightly.run(spark, specs_of(f"{folder}/landed"), root, AS_OF)
    merged, dropped = fold(records)
    expected = [row[:4] for row in long_form(merged)]
    latest = history.latest_snapshot(spark, f"{root}/history")
    assert sorted((r.sku, r.item, r.branch, r.qty) for r in latest.collect()) == expected
    order = {sku: n for n, (sku, _) in enumerate(sorted(merged.items(), key=lambda e: e[1][2]))}
    found = [r.sku for r in latest.select("sku", "entry_ord").distinct()
             .orderBy("entry_ord").collect()]
    assert found == sorted(order, key=order.get)
    rejected = nightly.read_report(spark, root, "rejects").where("reason like 'SKU is%'")
    assert rejected.count() == len(dropped)
    assert names(spark, root) == ["020126_012637.json"]


def test_run_again_and_later(spark, folder):
    land(f"{folder}/landed", random.Random(3))
    root, specs = f"{folder}/out", specs_of(f"{folder}/landed")
    nightly.run(spark, specs, root, AS_OF)
    first = history.snapshot_at(spark, f"{root}/history", "020126_012637").count()
    nightly.run(spark, specs, root, AS_OF)
    assert history.read_history(spark, f"{root}/history").count() == first
    nightly.run(spark, specs, root, AS_OF + timedelta(days=32))
    assert names(spark, root) == ["030226_012637.json", "020126_012637.json"]
    assert history.read_history(spark, f"{root}/history").count() == 2 * first


def test_a_failed_run_leaves_the_history_and_rebuilds_the_index(spark, folder):
    land(f"{folder}/landed", random.Random(4))
    root, specs = f"{folder}/out", specs_of(f"{folder}/landed")
    nightly.run(spark, specs, root, AS_OF)
    before = sorted(history.read_history(spark, f"{root}/history").collect())
    put(f"{folder}/landed/depot/sheet.csv", "1,2,3,4,5,6,7\n,s,i,,,,three\n")
    with pytest.raises(Exception, match="not a quantity"):
        nightly.run(spark, specs, root, AS_OF + timedelta(days=1))
    assert sorted(history.read_history(spark, f"{root}/history").collect()) == before
    assert names(spark, root) == ["020126_012637.json"]


def test_a_first_run_which_fails_leaves_an_empty_index(spark, folder):
    with pytest.raises(feeds.FeedError):
        nightly.run(spark, [feeds.hq_feed(f"{folder}/none")], f"{folder}/out", AS_OF)
    assert names(spark, f"{folder}/out") == []


def test_without_vending(spark, folder):
    records = land(f"{folder}/landed", random.Random(5))
    specs = [spec for spec in specs_of(f"{folder}/landed") if spec.name != "vend"]
    nightly.run(spark, specs, f"{folder}/out", AS_OF)
    merged, _ = fold([record for record in records if record[0] != 3])
    latest = history.latest_snapshot(spark, f"{folder}/out/history")
    found = sorted((r.sku, r.item, r.branch, r.qty) for r in latest.collect())
    assert found == [row[:4] for row in long_form(merged)]


def test_a_rerun_replaces_snapshot_document_and_rejects(spark, folder):
    land(f"{folder}/landed", random.Random(6))
    root, specs = f"{folder}/out", specs_of(f"{folder}/landed")
    put(f"{folder}/landed/vend/table.csv", "R,,,,,,,\n,,,,,,,\n1,2,3,4,5,6,7,8\n,,V1,v,,,,out\n,,V1,w,,,,3\n")
    nightly.run(spark, specs, root, AS_OF)
    assert nightly.read_report(spark, root, "rejects").where("reason like '%bad quantity'").count() == 2
    put(f"{folder}/landed/vend/table.csv", "R,,,,,,,\n,,,,,,,\n1,2,3,4,5,6,7,8\n,,V1,v,,,,5\n,,V1,w,,,,3\n")
    nightly.run(spark, specs, root, AS_OF)
    assert nightly.read_report(spark, root, "rejects").where("reason like '%bad quantity'").count() == 0
    status = nightly.read_report(spark, root, "feed_status")
    assert status.count() == len(STORES) + 4
    rows = history.latest_snapshot(spark, f"{root}/history")
    assert {r.sku for r in rows.where("branch = 'V1'").collect()} >= {"v", "w"}
    document = nightly.read_document(spark, root, "020126_012637.json")
    found = sorted(map(tuple, reconcile.explode_branches(document).collect()))
    assert found == sorted((r.sku, r.item, r.branch, r.qty) for r in rows.collect())
    assert {r.last_updated for r in document.collect()} == {"2026-01-02 01:26:37"}


def test_an_empty_snapshot_is_published(spark, folder):
    put(f"{folder}/hq.csv", "1,2,3,4,5,6,7,8\n,,,,,,,\n,,x,,,,,\n,,S1,i,,,,0\n")
    root = f"{folder}/out"
    nightly.run(spark, [feeds.hq_feed(f"{folder}/hq.csv")], root, AS_OF)
    assert names(spark, root) == ["020126_012637.json"]
    assert history.latest_snapshot(spark, f"{root}/history").count() == 0
    assert nightly.read_document(spark, root, "020126_012637").count() == 0


def test_a_run_drops_what_it_staged(spark, folder):
    land(f"{folder}/landed", random.Random(7))
    before = set(os.listdir(f"{staging.staging_root(spark)}/stockweave"))
    nightly.run(spark, specs_of(f"{folder}/landed"), f"{folder}/out", AS_OF)
    assert set(os.listdir(f"{staging.staging_root(spark)}/stockweave")) == before


def test_documents_without_a_time_in_their_name_are_rejects(spark, folder):
    land(f"{folder}/landed", random.Random(8))
    root = f"{folder}/out"
    put(f"{root}/documents/old.json", "{}")
    nightly.run(spark, specs_of(f"{folder}/landed"), root, AS_OF)
    found = nightly.read_report(spark, root, "rejects").where("reason = 'no time in the name'").collect()
    assert [row.item for row in found] == ["old.json"]
