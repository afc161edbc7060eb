"""Commits, races, clocks, and the removal of what is replaced."""

from __future__ import annotations

import os
import random
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from stockweave.plans import nightly
from stockweave.schemas import SNAPSHOT
from stockweave.sources import commits, history, retention, staging
from test_nightly import land, names, specs_of

AS_OF = datetime(2026, 1, 1, 18, 26, 37, tzinfo=timezone.utc)
STAMP = "2026-01-02 01:26:37"


def rows_of(spark, qty, count=3, ts=STAMP):
    rows = [(f"S{n}", "i", "HQ", float(qty), n) for n in range(count)]
    return spark.createDataFrame(rows, SNAPSHOT).withColumn("snapshot_ts", F.lit(ts).cast("timestamp_ntz"))


def files_below(folder):
    return sorted(os.path.join(p, f) for p, _, fs in os.walk(folder) for f in fs if not f.startswith((".", "_")))


def test_a_file_is_created_once(spark, folder):
    path = f"{folder}/log/x.json"
    assert commits.create_if_absent(spark, path, "erste ๕\n")
    assert not commits.create_if_absent(spark, path, "second")
    assert open(path, encoding="utf-8").read() == "erste ๕\n"
    assert files_below(f"{folder}/log") == [path]


def test_writers_at_once_get_numbers_of_their_own(spark, folder):
    with ThreadPoolExecutor(8) as pool:
        found = list(pool.map(lambda n: commits.commit(spark, folder, str(n), seen=0), range(24)))
    assert sorted(found) == list(range(1, 25)) == commits.numbers(spark, folder)
    assert sorted(int(open(commits.path_of(folder, n)).read()) for n in found) == list(range(24))


def test_runs_at_once_leave_one_winner(spark, folder):
    def append(qty):
        return history.append_snapshots(rows_of(spark, qty, count=qty), folder, seen=0), qty

    with ThreadPoolExecutor(4) as pool:
        done = dict(pool.map(append, (1, 2, 3, 4)))
    winner = done[max(done)]
    entry = history.published(spark, folder).first()
    assert (entry.n_rows, str(entry.snapshot_date)) == (winner, "2026-01-02")
    latest = history.latest_snapshot(spark, folder).collect()
    assert [row.qty for row in latest] == [float(winner)] * winner
    assert history.read_history(spark, folder).count() == winner


def test_a_slow_clock_does_not_matter(spark, folder, monkeypatch):
    history.append_snapshots(rows_of(spark, 1), folder)
    monkeypatch.setattr(time, "time", lambda: 0.0)
    monkeypatch.setattr(time, "time_ns", lambda: 0)
    history.append_snapshots(rows_of(spark, 2), folder)
    for path in files_below(f"{folder}/log")[1:]:
        os.utime(path, (1, 1))
    assert {row.qty for row in history.latest_snapshot(spark, folder).collect()} == {2.0}


def test_a_late_index_does_not_replace_a_newer_one(spark, folder):
    catalogs = [
        history.catalog(spark.createDataFrame([(n,) for n in found], "file_name string"))
        for found in (["020126_012637.json"], ["020126_012637.json", "030126_012637.json"])
    ]
    history.write_index(catalogs[1], f"{folder}/index", number=2)
    history.write_index(catalogs[0], f"{folder}/index", number=1)
    assert history.read_index(spark, f"{folder}/index").count() == 2


def test_sweep_leaves_just_what_the_log_names(spark, folder):
    for qty, ts in ((1, STAMP), (2, "2026-01-03 01:00:00"), (3, STAMP), (4, STAMP)):
        history.append_snapshots(rows_of(spark, qty, ts=ts), folder)
    history.write_version(  # a run that failed before its commit
        rows_of(spark, 9).select(*SNAPSHOT.names, F.lit("2026-01-02").alias("snapshot_date"), F.lit("x").alias("snapshot_id")),
        f"{folder}/rows", "failed", "snapshot_date", "snapshot_id",
    )
    expected = sorted(map(tuple, history.read_history(spark, folder).collect()))
    assert retention.sweep_history(spark, folder, grace=3600) == []
    removed = retention.sweep_history(spark, folder, grace=0)
    assert any("version=failed" in path for path in removed)
    left = spark.read.schema(history.HISTORY).parquet(f"{folder}/rows").drop("version")
    assert sorted(map(tuple, left.select(*history.read_history(spark, folder).columns).collect())) == expected
    assert len(os.listdir(f"{folder}/rows")) == 2
    assert commits.numbers(spark, f"{folder}/log") == [2, 4]
    assert retention.sweep_history(spark, folder, grace=0) == []
    assert history.append_snapshots(rows_of(spark, 5), folder) == 5


def test_a_version_of_several_snapshots_loses_the_replaced_ones(spark, folder):
    both = rows_of(spark, 1).unionByName(rows_of(spark, 2, ts="2026-01-03 01:00:00"))
    history.append_snapshots(both, folder)
    history.append_snapshots(rows_of(spark, 3), folder)
    removed = retention.sweep_history(spark, folder, grace=0)
    assert [path.rsplit("/", 1)[1] for path in removed] == ["snapshot_id=020126_012637"]
    assert sorted(row.qty for row in history.read_history(spark, folder).collect()) == [2.0] * 3 + [3.0] * 3


def test_readers_in_flight_pass(spark, folder):
    history.append_snapshots(rows_of(spark, 1), folder)
    opened = history.latest_snapshot(spark, folder)
    history.append_snapshots(rows_of(spark, 2), folder)
    retention.sweep_history(spark, folder, grace=60)
    assert {row.qty for row in opened.collect()} == {1.0}
    # what is old by its own files is young as long as its successor is
    for path in files_below(f"{folder}/rows"):
        os.utime(path, (1, 1))
    retention.sweep_history(spark, folder, grace=60)
    assert {row.qty for row in opened.collect()} == {1.0}


def test_sweep_of_a_nightly_root(spark, folder):
    land(f"{folder}/landed", random.Random(3))
    root, specs = f"{folder}/out", specs_of(f"{folder}/landed")
    for when in (AS_OF, AS_OF, AS_OF + timedelta(days=1), AS_OF):
        nightly.run(spark, specs, root, when)
    with pytest.raises(Exception):
        nightly.run(spark, [*specs[:-1], specs_of(f"{folder}/nowhere")[-1]], root, AS_OF)
    reports = {n: sorted(map(str, nightly.read_report(spark, root, n).collect())) for n in ("rejects", "feed_status")}
    document = sorted(map(str, nightly.read_document(spark, root, "020126_012637").collect()))
    rows = sorted(map(str, history.read_history(spark, f"{root}/history").collect()))
    open(f"{root}/documents/old.json", "w").close()
    assert retention.sweep(spark, root, grace=0)
    assert reports == {n: sorted(map(str, nightly.read_report(spark, root, n).collect())) for n in reports}
    assert document == sorted(map(str, nightly.read_document(spark, root, "020126_012637").collect()))
    assert rows == sorted(map(str, history.read_history(spark, f"{root}/history").collect()))
    assert names(spark, root) == ["030126_012637.json", "020126_012637.json"]
    for name in ("history/rows", "rejects", "feed_status"):
        assert len(os.listdir(f"{root}/{name}")) == 2, name
    assert len(files_below(f"{root}/index")) == 1
    assert [len(os.listdir(f"{root}/documents/{n}")) for n in ("020126_012637.json", "030126_012637.json")] == [1, 1]
    assert os.path.exists(f"{root}/documents/old.json")
    assert retention.sweep(spark, root, grace=0) == []


def test_sweep_of_staged_tables(spark):
    staged = staging.stage(spark.range(3), "old")
    folder = os.path.dirname(staged.inputFiles()[0].removeprefix("file://"))
    assert not any(folder in path for path in retention.sweep_staging(spark, grace=3600))
    for path in [folder, *(os.path.join(folder, f) for f in os.listdir(folder))]:
        os.utime(path, (1, 1))
    assert any(path.endswith(os.path.basename(folder)) for path in retention.sweep_staging(spark, grace=3600))
    assert not os.path.exists(folder)
