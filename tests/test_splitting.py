"""One large document read by many tasks, cut at every size, against Python's own readers."""

from __future__ import annotations

import csv
import io
import json
import random
from contextlib import contextmanager

import pytest

from stockweave.plans.nightly import read_feeds
from stockweave.sources import feeds, splitting
from test_feeds import put, records

SIZES = (3, 17, 64, 1000, 1 << 20)


@contextmanager
def split_at(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def odd_text(rng):
    parts = ["a", "{", "}", "[", "]", '"', "\\", ",", ":", "\n", "\t", "é", "๕", "🙂", "list", "null", '{"list":[', " "]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 6)))


def odd_document(rng):
    """A product list between other keys, with inner objects and lists, and strings full of brackets."""
    def value(depth=0):
        kind = rng.randint(0, 6 if depth < 3 else 3)
        if kind <= 1:
            return odd_text(rng)
        if kind == 2:
            return rng.choice([None, True, 1.5, -3])
        if kind == 3:
            return []
        if kind == 4:
            return [value(depth + 1) for _ in range(rng.randint(0, 3))]
        return {odd_text(rng): value(depth + 1) for _ in range(rng.randint(0, 3))}

    entries = []
    for n in range(rng.randint(0, 8)):
        entry = {"sku": f"S{n}{odd_text(rng)}", "availablestock": rng.choice([n, str(n), n / 4])}
        if rng.random() < 0.5:
            entry[f"x{odd_text(rng)}"] = value()
        if rng.random() < 0.2:
            entry["list"] = [{"sku": "inner", "availablestock": 1}]
        entries.append(dict(rng.sample(list(entry.items()), len(entry))))
    document = {f"k{n}{odd_text(rng)}": value() for n in range(rng.randint(0, 3))}
    document["other"] = {"list": [{"sku": "no", "availablestock": 1}], "a": {}}
    document["list"] = entries
    document |= {f"z{n}": value() for n in range(rng.randint(0, 2))}
    document = dict(rng.sample(list(document.items()), len(document)))
    return document, entries


def as_read(entries):
    return [(e["sku"], float(e["availablestock"])) for e in entries]


def found_in(spark, folder, **options):
    clean = read_feeds(spark, [feeds.api_feed(folder, **options)])
    return [(sku, qty) for _, sku, _, qty in records(clean)]


@pytest.mark.parametrize("size", SIZES)
def test_product_lists_match_the_json_module(spark, folder, size):
    rng = random.Random(size)
    expected = []
    for n in range(25):
        document, entries = odd_document(rng)
        text = json.dumps(document, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1, 3]))
        put(folder, f"{n:03}.json", rng.choice(["", "\n "]) + text + rng.choice(["", "\n", " \n\n"]))
        expected += as_read(entries)
    with split_at(spark, size):
        assert found_in(spark, folder) == expected


@pytest.mark.parametrize("text", [
    '{"list":[{"sku":"a","availablestock":1}]', '{"list":[{"sku":"a","availablestock":1}', '{"list":[{"sku":"a', "nothing",
    '[{"sku":"a","availablestock":1}]', '{"list":[{"sku":"a","availablestock":1}]}}', '{"list":[{"sku":"a","availablestock":1} 5]}',
    '{"list":[1, {"sku":"a","availablestock":1}]}', '{"list":[{"sku":"a","availablestock":1}{"sku":"b","availablestock":1}]}',
    '{"list":[{"sku":"a" "availablestock":1}]}',
])
def test_broken_product_lists_fail(spark, folder, text):
    put(folder, "a.json", '{"list":[{"sku":"x","availablestock":1}]}')
    put(folder, "b.json", text)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        found_in(spark, folder)


@pytest.mark.parametrize("text", ['{"list":[]}', "{}", '{"list":null}', '{"res":"nothing"}\n', '{"list":[null, {"sku":"a","availablestock":1}, null]}'])
def test_short_product_lists(spark, folder, text):
    put(folder, "a.json", text)
    assert found_in(spark, folder) == ([("a", 1.0)] if "sku" in text else [])


def test_a_document_of_one_line_is_read_by_many_tasks(spark, folder):
    entries = [{"sku": f"S{n}", "availablestock": n, "note": "x" * 50 + "}"} for n in range(20_000)]
    put(folder, "big.json", json.dumps({"count": 1, "list": entries}))
    with split_at(spark, 100_000):
        pieces = splitting.text_pieces(spark, [folder], "}")
        assert pieces.rdd.getNumPartitions() >= 10
        assert pieces.select("block").distinct().count() >= 10
        elements = splitting.json_elements(spark, [folder], "list")
        assert elements.count() == 20_000
        assert found_in(spark, folder) == as_read(entries)


def odd_cell(rng):
    parts = ["a", '"', ",", "\n", "\r\n", "é", "๕", '""', " ", "'", "\n\n"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 5)))


@pytest.mark.parametrize("size", SIZES)
def test_sheets_with_line_breaks_match_the_csv_module(spark, folder, size):
    rng = random.Random(size + 1)
    expected = []
    for n in range(6):
        rows = [["No", "Item", "SKU", "Available Qty."]]
        for m in range(rng.randint(0, 30)):
            rows.append([str(m), f"i{odd_cell(rng)}x", f"S{odd_cell(rng)}y", str(m)])
        text = io.StringIO(newline="")
        csv.writer(text, quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]), lineterminator=rng.choice(["\n", "\r\n"])).writerows(rows)
        written = text.getvalue()
        put(folder, f"branch=A/{n}.csv", written if rng.random() < 0.7 else written.rstrip("\r\n"))
        expected += [(row[1].replace("\r\n", "\n"), row[2].replace("\r\n", "\n"), "A", float(row[3])) for row in rows[1:]]
    with split_at(spark, size):
        clean = read_feeds(spark, [feeds.pos_feed(folder, ("A",), multi_line=True)])
        assert [(i.replace("\r\n", "\n"), s.replace("\r\n", "\n"), b, q) for i, s, b, q in records(clean)] == expected


def test_quotes_inside_plain_cells_open_nothing(spark, folder):
    put(folder, "branch=A/a.csv", 'Item,SKU,Available Qty.\n5" pipe,S1,1\n"6"" pipe",S2,2\n"two\nlines",S3,3\nx "y" z,S4,4\n\n7",S5,5\n')
    for size in (5, 1 << 20):
        with split_at(spark, size):
            clean = read_feeds(spark, [feeds.pos_feed(folder, ("A",), multi_line=True)])
            assert [row[0] for row in records(clean)] == ['5" pipe', '6" pipe', "two\nlines", 'x "y" z', '7"']


def test_a_sheet_with_another_header_is_lost(spark, folder):
    put(folder, "branch=A/a.csv", "Item,SKU,Available Qty.\na,S1,1\n")
    put(folder, "branch=B/a.csv", 'SKU,"Available Qty.",Item\nS2,2,"b\nc"\n')
    put(folder, "branch=C/a.csv", "Item,Stock\nS2,2\n")
    clean = read_feeds(spark, [feeds.pos_feed(folder, ("A", "B", "C"), multi_line=True)])
    assert records(clean) == [("a", "S1", "A", 1.0), ("b\nc", "S2", "B", 2.0)]


def test_titles_with_line_breaks_are_skipped_as_rows(spark, folder):
    put(folder, "v.csv", '"Report\nof\nstock",,,,,,,\n"and\nmore",,,,,,,\nn,id,site,sku,a,b,c,left\n1,x,Park,V1,,,,5\n2,x,Park,V2,,,,6\n')
    for size in (6, 1 << 20):
        with split_at(spark, size):
            clean = read_feeds(spark, [feeds.vend_feed(folder, multi_line=True)])
            assert records(clean) == [(None, "V1", "Park", 5.0), (None, "V2", "Park", 6.0)]


def test_states_are_those_of_a_fold(spark):
    """Random changes of state in random blocks, against a loop."""
    rng = random.Random(2)
    rows, expected = [], []
    for path in "ab":
        state, position = 0, 0
        for block in range(12):
            for _ in range(rng.randint(0, 9)):
                ends = rng.choice([(0, 1), (0, 1), (1, 0), (0, 0), (1, 1)])
                rows.append((path, block, position, "x", *ends))
                expected.append((path, position, state))
                state, position = ends[state], position + rng.randint(1, 5)
    frame = spark.createDataFrame(rows, "path string, block long, position long, value string, zero int, one int").repartition(6)
    found = splitting.with_states(frame, frame.zero, frame.one).select("path", "position", "state").collect()
    assert sorted(map(tuple, found)) == expected


@pytest.mark.parametrize("lines", (50, 400))
def test_tasks_grow_with_the_files_and_not_with_the_setting(spark, folder, monkeypatch, lines):
    """Sorts of a task stay as large as the blocks it is dealt, however few partitions are set."""
    monkeypatch.setattr(splitting, "TASK_BYTES", 64)
    monkeypatch.setattr(splitting, "STRETCH", 64)
    put(folder, "a.csv", "".join(f'S{n:04d},"a\n{n}"\n' for n in range(lines)))
    put(folder, "b.json", json.dumps({"list": [{"sku": f"S{n:04d}", "availablestock": n} for n in range(lines)]}))
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        with split_at(spark, 512):
            for found, size in (
                (splitting.csv_records(spark, [f"{folder}/a.csv"]), 12 * lines),
                (splitting.json_elements(spark, [f"{folder}/b.json"], "list"), 35 * lines),
            ):
                assert found.rdd.getNumPartitions() >= size // 512
                assert found.count() == lines
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
