"""Registered queries: every operator over the whole given tables.

The stock feed is derived from ``events``: the event type gives the phase, the event id the order.
Queries on sources and sinks land the table as files first and read it with the real readers.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockweave.functions import casting, naming, stock
from stockweave.operators import lookup, prefix, projection, reconcile, serving
from stockweave.plans import dashboard, nightly
from stockweave.plans.landing import (
    land_depot, land_hq, land_lines, land_lists, land_products, land_stores, land_vending,
)
from stockweave.sources import dimensions, documents, feeds, history, retention
from stockweave.sources.staging import new_path, stage

EVENT_TYPES = ("view", "purchase", "signup", "click", "error")
ALIASES = {"Brand#1": "CANON-1", "Brand#7": "CANON-7", "Brand#12": "CANON-1"}
GROUPS = {
    "store": ("B0", "B1", "B2"), "hq": ("B3",), "online": ("B4",), "vending": ("B5", "B6"),
}
SELECTED = ("B0", "B3", "B5")
STORES = tuple(f"B{n}" for n in range(8))
ORD_STEP = 10**18
SKUS_PER_PART = 1_000
#: Characters that a store name may hold and a path has to escape.
ODD_STORE = ": 5% [a]"
AS_OF = datetime(2024, 1, 31, 18, 30, tzinfo=timezone.utc)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


# -- derived inputs ---------------------------------------------------------------------------


def phase_of(event_type: Column) -> Column:
    phases = reduce(
        lambda case, phase: case.when(event_type == EVENT_TYPES[phase - 1], phase),
        (2, 3, 4), F.when(event_type == EVENT_TYPES[0], 1),
    )
    return phases.otherwise(5)


def sku_of(event_id: Column) -> Column:
    """SKUs of two kinds: a thousand hot ones, and as many as a sixth of the table's events."""
    rare = F.floor(event_id / 6).cast("bigint")
    return F.when(event_id % 3 == 0, rare).otherwise(event_id * 7 % 997).cast("string")


def branch_of(event_id: Column) -> Column:
    return F.concat(F.lit("B"), (event_id % 8).cast("string"))


def stock_rows(rows: DataFrame, phase: Column) -> DataFrame:
    """Events as stock records with the layout of :data:`stockweave.schemas.FEED`, and event_id."""
    event_id = F.col("event_id")
    return rows.select(
        phase.alias("phase"),
        (phase.cast("bigint") * ORD_STEP + event_id).alias("ord"),
        F.when(~phase.isin(2, 3), F.col("user_id").cast("string")).alias("item"),
        sku_of(event_id).alias("sku"),
        branch_of(event_id).alias("branch"),
        F.col("value").alias("qty"),
        event_id,
    )


def feed_rows(rows: DataFrame, phase: Column) -> DataFrame:
    return stock_rows(rows, phase).drop("event_id")


def stock_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean feed of all phases."""
    return feed_rows(events(spark, sf_dir), phase_of(F.col("event_type")))


def phase_rows(spark: SparkSession, sf_dir: str, phase: int) -> DataFrame:
    """Stock records of one phase; the choice of events reaches the scan."""
    kind = F.col("event_type")
    chosen = kind == EVENT_TYPES[phase - 1] if phase < 5 else ~kind.isin(*EVENT_TYPES[:4])
    return stock_rows(events(spark, sf_dir).where(chosen), F.lit(phase))


def phase_feed(spark: SparkSession, sf_dir: str, phase: int) -> DataFrame:
    return phase_rows(spark, sf_dir, phase).drop("event_id")


def dirty_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities as they stand in a badly kept sheet."""
    event_id = F.col("event_id")
    words = (
        "NA", "", "1,234", "5d", "-3", "0.5", "2.9", " 5 ", "\t7", "\u00a08", "๕", "1_000", "1__0",
    )
    text = (event_id % 50).cast("string")
    for rest, word in enumerate(words):
        text = F.when(event_id % 14 == rest, word).otherwise(text)
    return events(spark, sf_dir).select("event_id", "event_type", text.alias("qty_text"))


def reconciled(spark: SparkSession, sf_dir: str) -> reconcile.Reconciliation:
    return reconcile.reconcile(stock_feed(spark, sf_dir))


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconciled(spark, sf_dir).snapshot()


def selected_totals(spark: SparkSession, sf_dir: str, branches=SELECTED) -> DataFrame:
    totals = serving.rollup(snapshot(spark, sf_dir), branches)
    return totals.withColumn("qty", F.round("qty", 2))


def all_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selected_totals(spark, sf_dir, None)


def daily_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot per day of the events: last value per user and event type."""
    per_day = events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    stamps = per_day.groupBy("day").agg(F.max("ts").alias("snapshot_ts"))
    rows = per_day.groupBy("day", "user_id", "event_type").agg(
        F.max_by("value", "event_id").alias("qty"), F.min("event_id").alias("entry_ord")
    )
    return rows.join(stamps, "day").select(
        F.col("user_id").cast("string").alias("sku"),
        F.concat(F.lit("item "), "user_id").alias("item"),
        F.col("event_type").alias("branch"),
        "qty", "entry_ord", "snapshot_ts",
    )


def daily_history(spark: SparkSession, sf_dir: str) -> str:
    root = new_path(spark, "history")
    history.append_snapshots(history.gathered(daily_snapshots(spark, sf_dir)), root)
    return root


def day_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = events(spark, sf_dir).groupBy(F.to_date("ts").alias("day")).agg(
        F.max("ts").alias("ts")
    )
    return history.catalog(days.select(naming.file_name(F.col("ts")).alias("file_name")))


def cleaned(spark: SparkSession, spec: feeds.FeedSpec) -> DataFrame:
    return nightly.read_feeds(spark, [spec]).records


# -- queries on feeds -------------------------------------------------------------------------


def feed_scan_tagged(spark, sf_dir):
    event_id = F.col("event_id")
    rows = events(spark, sf_dir).select(
        "event_id", F.col("event_type").alias("store"), F.col("user_id").alias("item"),
        sku_of(event_id).alias("sku"), F.col("value").alias("qty"),
    )
    rows = rows.withColumn("store", F.concat("store", F.lit(ODD_STORE)))
    path = land_stores(rows, new_path(spark, "stores"))
    stores = [f"{kind}{ODD_STORE}" for kind in EVENT_TYPES]
    return cleaned(spark, feeds.pos_feed(path, stores)).select("branch", "item", "sku", "qty")


def listed_products(spark, sf_dir) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_id", F.col("event_id").alias("sku"),
        F.get_json_object("props", "$.k").alias("stock"),
    )


def product_counts(spark, spec: feeds.FeedSpec) -> DataFrame:
    return cleaned(spark, spec).select(
        F.col("sku").cast("bigint").alias("event_id"), F.col("qty").cast("bigint").alias("k")
    )


def api_inline(spark, sf_dir):
    path = land_products(listed_products(spark, sf_dir), new_path(spark, "products"))
    return product_counts(spark, feeds.api_feed(path, multi_line=False))


def api_documents(spark, sf_dir):
    """Files that are one document each, split into their entries."""
    path = land_lists(listed_products(spark, sf_dir), new_path(spark, "lists"))
    return product_counts(spark, feeds.api_feed(path))


def sheet_line_breaks(spark, sf_dir):
    """A sheet whose cells hold line breaks, commas and quotes."""
    rows = events(spark, sf_dir).select(
        "event_id", F.col("event_id").alias("sku"),
        F.concat("event_type", F.lit('\n"two", \n'), F.col("event_id") % 7, F.lit('"')).alias("item"),
        (F.col("event_id") % 50).alias("qty"),
    )
    path = land_depot(rows, new_path(spark, "breaks"))
    records = cleaned(spark, feeds.depot_feed(path, aliases={}, multi_line=True))
    return records.select(
        F.col("sku").cast("bigint").alias("event_id"), "item", F.col("qty").cast("bigint").alias("qty")
    )


def vending_records(spark, sf_dir, bad: Column) -> DataFrame:
    """The events through a vending feed, those that are ``bad`` without a quantity."""
    qty = F.when(bad, "broken").otherwise(F.col("value").cast("string"))
    rows = events(spark, sf_dir).select(
        "event_id", F.col("event_type").alias("branch"),
        F.col("event_id").cast("string").alias("sku"), qty.alias("qty"),
    )
    path = land_vending(rows, new_path(spark, "vending"))
    return cleaned(spark, feeds.vend_feed(path)).select(
        F.col("sku").cast("bigint").alias("event_id"), "branch", "qty"
    )


def late_and_large(spark, sf_dir) -> Column:
    """Large values in the last tenth of the events."""
    last = events(spark, sf_dir).agg(F.max("event_id")).scalar()
    return (F.col("value") > 300) & (F.col("event_id") * 10 > last * 9)


def vend_positional(spark, sf_dir):
    return vending_records(spark, sf_dir, late_and_large(spark, sf_dir))


def vend_whole(spark, sf_dir):
    return vending_records(spark, sf_dir, F.lit(False))


def sheet_bad_width(spark, sf_dir):
    """A sheet in which every tenth row has a cell too many: kept rows, and rejected ones."""
    event_id = F.col("event_id")
    cells = F.concat_ws(
        ",", F.lit("x"), F.lit("x"), F.lit('"a, b"'), event_id.cast("string"), F.lit(""), F.lit(""),
        F.lit(""), (event_id % 50).cast("string"), F.when(event_id % 10 == 3, "99"),
    )
    lines = events(spark, sf_dir).select("event_id", cells.alias("value"))
    path = land_lines(lines, "event_id", new_path(spark, "wide"), "a,b,site,code,c,d,e,left")
    clean = nightly.read_feeds(spark, [
        feeds.vend_feed(path, header=True, skip_rows=0, on_bad="reject_row")
    ])
    kept = clean.records.select("sku", "branch", F.lit("kept").alias("fate"))
    lost = clean.rejects.select("sku", "branch", F.col("reason").alias("fate"))
    return kept.unionByName(lost)


def hq_sheet(spark, sf_dir):
    rows = dirty_cells(spark, sf_dir).select(
        "event_id", F.col("event_id").alias("sku"), F.col("event_type").alias("item"),
        F.col("qty_text").alias("qty"),
    )
    path = land_hq(rows, new_path(spark, "hq"))
    return cleaned(spark, feeds.hq_feed(path)).select(
        F.col("sku").cast("bigint").alias("event_id"), "item",
        F.col("qty").cast("bigint").alias("qty"),
    )


def depot_sheet(spark, sf_dir):
    """Quantities in the spellings that the strict rules read."""
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    spelt = (
        F.when(key % 5 == 1, F.translate(size, "0123456789", "๐๑๒๓๔๕๖๗๘๙"))
        .when(key % 5 == 2, F.concat(F.lit("\u00a0"), size, F.lit("\u2003")))
        .when(key % 5 == 3, F.regexp_replace(size, "^([0-9])([0-9])$", "$1_$2.9"))
        .otherwise(size)
    )
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_brand").alias("sku"), key.alias("item"), spelt.alias("qty"),
    )
    path = land_depot(rows, new_path(spark, "depot"), "p_partkey")
    return cleaned(spark, feeds.depot_feed(path, aliases=ALIASES)).select(
        "item", "sku", F.col("qty").cast("bigint").alias("qty")
    )


def feed_status(spark, sf_dir):
    rows = events(spark, sf_dir).select(
        "event_id", F.col("event_type").alias("store"), F.col("user_id").alias("item"),
        sku_of(F.col("event_id")).alias("sku"), F.col("value").alias("qty"),
    )
    path = land_stores(rows, new_path(spark, "stores"))
    spec = feeds.pos_feed(path, (*EVENT_TYPES, "closed store"))
    return nightly.read_feeds(spark, [spec]).status.select("unit", "status", "n_rows")


def positional_projection(spark, sf_dir):
    return projection.pick_positions(events(spark, sf_dir), {"sku": 2, "item": 3, "qty": 4})


def row_offset(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "value")
    return projection.skip_rows(rows, 2, "event_id")


def drop_all_null(spark, sf_dir):
    event_id = F.col("event_id")
    rows = events(spark, sf_dir).select(
        F.when(event_id % 3 != 0, F.col("event_type")).alias("a"),
        F.when(event_id % 2 != 0, F.col("value")).alias("b"),
    )
    return projection.drop_all_null(rows)


def feed_union(spark, sf_dir):
    return nightly.union([phase_feed(spark, sf_dir, phase) for phase in range(1, 6)])


# -- queries on cleaning ----------------------------------------------------------------------


def hq_clean(spark, sf_dir):
    rows = dirty_cells(spark, sf_dir)
    qty = casting.coerced_int(casting.na_to_null(F.col("qty_text")))
    return rows.select("event_id", qty.alias("qty")).where(F.col("qty") > 0)


def depot_clean(spark, sf_dir):
    qty = casting.require_int(F.col("l_quantity").cast("string"), "depot")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", qty.alias("qty")
    )


def na_normalise(spark, sf_dir):
    return dirty_cells(spark, sf_dir).select(
        "event_id", casting.na_to_null(F.col("qty_text")).alias("qty_text")
    )


def cast_strict_int(spark, sf_dir):
    return dirty_cells(spark, sf_dir).select(
        "event_id", casting.strict_int_from_text(F.col("qty_text")).alias("qty")
    )


def cast_strict_double(spark, sf_dir):
    qty = casting.require_double(F.col("value").cast("string"), "online shop")
    return events(spark, sf_dir).select("event_id", qty.alias("qty"))


def prefix_until_bad(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", "event_type", "value")
    return prefix.prefix_until_bad(rows, ["event_type"], "event_id", F.col("value") > 300)


def sku_alias_map(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("sku"))
    return lookup.canonical_sku(parts, dimensions.alias_table(spark, ALIASES))


# -- queries on reconciliation ----------------------------------------------------------------


def item_registry(spark, sf_dir):
    return reconciled(spark, sf_dir).entries.select("item", "sku", "entry_ord")


def resolve_by_item(spark, sf_dir):
    return reconciled(spark, sf_dir).resolved_by_item()


def resolve_by_sku(spark, sf_dir):
    return reconciled(spark, sf_dir).resolved_by_sku()


def new_sku_entries(spark, sf_dir):
    return reconcile.new_sku_entries(reconciled(spark, sf_dir).heads)


def dropped_sku_name_clash(spark, sf_dir):
    return reconciled(spark, sf_dir).dropped().select("ord", "sku")


def branch_last_wins(spark, sf_dir):
    return reconcile.last_per_branch(stock_feed(spark, sf_dir))


def snapshot_reconcile(spark, sf_dir):
    return snapshot(spark, sf_dir).select("sku", "item", "branch", "qty")


def snapshot_ordered(spark, sf_dir):
    names = reconcile.sku_names(reconciled(spark, sf_dir).entries)
    return names.select("sku", "item", "entry_ord").orderBy("entry_ord")


def snapshot_nested(spark, sf_dir):
    pairs = F.transform(
        F.map_entries("branches"),
        lambda pair: F.concat(
            pair["key"], F.lit("="), pair["value"].cast("decimal(18,2)").cast("string")
        ),
    )
    return reconcile.nested(snapshot(spark, sf_dir)).select(
        "sku", "item", F.array_join(pairs, ",").alias("branches")
    )


def explode_branches(spark, sf_dir):
    return reconcile.explode_branches(reconcile.nested(snapshot(spark, sf_dir)))


def landed_feeds(spark, sf_dir) -> list[feeds.FeedSpec]:
    """All five feeds landed as files."""
    by_phase = {phase: phase_rows(spark, sf_dir, phase) for phase in range(1, 6)}
    products = by_phase[2].withColumn("stock", F.col("qty").cast("string"))
    return [
        feeds.pos_feed(land_stores(store_rows(by_phase[1]), new_path(spark, "stores")), STORES),
        feeds.api_feed(land_products(products, new_path(spark, "products")), multi_line=False),
        feeds.vend_feed(land_vending(by_phase[3], new_path(spark, "vending"))),
        feeds.hq_feed(land_hq(by_phase[4], new_path(spark, "hq"))),
        feeds.depot_feed(land_depot(by_phase[5], new_path(spark, "depot"))),
    ]


def store_rows(stock: DataFrame) -> DataFrame:
    return stock.withColumn("store", F.col("branch"))


def nightly_run(spark, sf_dir):
    """All five feeds landed as files, one whole run, the latest snapshot read back."""
    root = new_path(spark, "run")
    nightly.run(spark, landed_feeds(spark, sf_dir), root, AS_OF)
    latest = history.latest_snapshot(spark, f"{root}/history")
    return latest.select("sku", "item", "branch", "qty")


def mended_run(spark, sf_dir):
    """A run with one store broken, and an incremental one after it has landed again."""
    specs, root = landed_feeds(spark, sf_dir), new_path(spark, "run")
    store = store_rows(phase_rows(spark, sf_dir, 1)).where(F.col("branch") == STORES[3])
    broken = store.withColumn("qty", F.when(F.col("event_id") % 5 != 0, F.col("qty").cast("string")).otherwise("?"))
    for rows in (broken, store):
        land_stores(rows, specs[0].path, mode="overwrite")
        nightly.run(spark, specs, root, AS_OF, incremental=True)
    latest = history.latest_snapshot(spark, f"{root}/history")
    return latest.select("sku", "item", "branch", "qty")


def vending_run(spark, sf_dir, root: str, bad: Column) -> None:
    """One nightly run of a vending feed alone."""
    qty = F.when(bad, "broken").otherwise(F.col("value").cast("string"))
    rows = events(spark, sf_dir).select(
        "event_id", F.col("event_type").alias("branch"),
        F.col("event_id").cast("string").alias("sku"), qty.alias("qty"),
    )
    spec = feeds.vend_feed(land_vending(rows, new_path(spark, "vending")))
    nightly.run(spark, [spec], root, AS_OF)


def rerun_replaces(spark, sf_dir):
    """A run with rejects, and the same run again after the feed was mended."""
    root = new_path(spark, "run")
    vending_run(spark, sf_dir, root, late_and_large(spark, sf_dir))
    vending_run(spark, sf_dir, root, F.lit(False))
    rows = history.read_history(spark, f"{root}/history").select("sku", "branch", "qty")
    lost = nightly.read_report(spark, root, "rejects")
    return rows.unionByName(lost.select("sku", "branch", F.lit(None).cast("double").alias("qty")))


def nightly_document(spark, sf_dir):
    """The document that a run publishes under the name in its index."""
    root = new_path(spark, "run")
    vending_run(spark, sf_dir, root, F.lit(False))
    name = history.read_index(spark, f"{root}/index").first().file_name
    return reconcile.explode_branches(nightly.read_document(spark, root, name))


# -- queries on the history -------------------------------------------------------------------


def snapshot_read(spark, sf_dir):
    path = new_path(spark, "documents")
    updated = naming.last_updated_text(F.lit("2024-01-31 18:30:00").cast("timestamp_ntz"))
    documents.write_documents(snapshot(spark, sf_dir), path, updated)
    return reconcile.explode_branches(documents.read_documents(spark, path))


def snapshot_text_qty(spark, sf_dir):
    """Documents whose quantities are texts, read as far as they are numbers."""
    event_id = F.col("event_id")
    text = F.concat(
        F.when(event_id % 2 == 0, "  ").otherwise("-"), (event_id % 50).cast("string"),
        F.when(event_id % 3 == 0, "abc").when(event_id % 3 == 1, ".5 kg").otherwise("e1"),
    )
    entry = F.struct(
        F.lit("item").alias("Item"), event_id.cast("string").alias("SKU"),
        F.create_map(F.col("event_type"), text).alias("Branch"),
    )
    path = new_path(spark, "documents")
    events(spark, sf_dir).groupBy(F.floor(event_id / 1000)).agg(
        F.to_json(F.struct(F.lit("2024").alias("last_updated"), F.collect_list(entry).alias("inventory")))
        .alias("value")
    ).select("value").write.text(path)
    rows = reconcile.explode_branches(documents.read_documents(spark, path))
    return rows.select(F.col("sku").cast("bigint").alias("event_id"), "branch", "qty")


def daily_documents(spark, sf_dir):
    """The folder with the documents of all days, each day a folder of parts of limited size."""
    rows = daily_snapshots(spark, sf_dir).groupBy("snapshot_ts", "sku", "item").agg(
        F.map_from_entries(F.collect_list(F.struct("branch", "qty"))).alias("Branch")
    )
    numbered = stage(serving.number_rows(rows, F.col("snapshot_ts"), F.col("sku")), "daily-skus")
    days = numbered.groupBy("snapshot_ts").agg(
        F.min("row_no").alias("first_no"), F.ceil(F.count("*") / SKUS_PER_PART).alias("parts")
    )
    part = F.floor((F.col("row_no") - F.col("first_no")) / SKUS_PER_PART) + 1
    entry = F.struct(F.col("item").alias("Item"), F.col("sku").alias("SKU"), "Branch")
    parts = numbered.join(days, "snapshot_ts").groupBy("snapshot_ts", part.alias("part"), "parts").agg(
        F.collect_list(entry).alias("inventory")
    )
    body = F.struct(F.lit("2024").alias("last_updated"), "part", "parts", "inventory")
    path = new_path(spark, "old-documents")
    parts.select(F.to_json(body).alias("value"), naming.file_name(F.col("snapshot_ts")).alias("file")).write.partitionBy(
        "file"
    ).text(path)
    return path


def import_documents(spark, sf_dir):
    """Documents of all days, imported into a history."""
    path, root = daily_documents(spark, sf_dir), new_path(spark, "history")
    documents.import_documents(spark, path, root, multi_line=False)
    return history.read_history(spark, root).select("snapshot_id", "sku", "branch", "qty")


def sink_latest(spark, sf_dir):
    """Two runs, the later one is the latest snapshot."""
    root = new_path(spark, "history")
    rows = snapshot(spark, sf_dir)
    earlier = serving.select_branches(rows, SELECTED)
    for kept, ts in ((earlier, "2024-01-31 01:30:00"), (rows, "2024-02-01 01:30:00")):
        stamp = F.lit(ts).cast("timestamp_ntz")
        history.append_snapshots(kept.withColumn("snapshot_ts", stamp), root)
    return history.latest_snapshot(spark, root).select("sku", "item", "branch", "qty")


def lost_race(spark, sf_dir):
    """Two runs of one snapshot which both know of no other: the one that commits last replaces the
    other, with its date, version and count."""
    root = new_path(spark, "history")
    stamp = F.lit("2024-02-01 01:30:00").cast("timestamp_ntz")
    rows = snapshot(spark, sf_dir).withColumn("snapshot_ts", stamp)
    history.append_snapshots(serving.select_branches(rows, SELECTED), root, seen=0)
    history.append_snapshots(rows, root, seen=0)
    return history.latest_snapshot(spark, root).select("sku", "item", "branch", "qty")


def swept_history(spark, sf_dir):
    """All that is left on disk of a history whose days were each written twice."""
    root = new_path(spark, "history")
    rows = stage(history.gathered(daily_snapshots(spark, sf_dir)), "daily")
    history.append_snapshots(rows.where("branch <> 'view'"), root)
    history.append_snapshots(rows, root)
    retention.sweep_history(spark, root, grace=0)
    left = spark.read.schema(history.HISTORY).parquet(f"{root}/rows")
    return left.select("snapshot_id", "sku", "branch", "qty")


def sink_history(spark, sf_dir):
    rows = history.read_history(spark, daily_history(spark, sf_dir))
    return rows.select("snapshot_id", "sku", "branch", "qty")


def sink_catalog(spark, sf_dir):
    path = new_path(spark, "index")
    history.write_index(day_catalog(spark, sf_dir), path, indent=4)
    return history.read_index(spark, path)


def snapshot_catalog(spark, sf_dir):
    return history.catalog(history.snapshot_ids(spark, daily_history(spark, sf_dir)))


def latest_snapshot(spark, sf_dir):
    return history.latest_name(day_catalog(spark, sf_dir))


def snapshot_count(spark, sf_dir):
    return history.snapshot_count(day_catalog(spark, sf_dir))


def snapshot_at(spark, sf_dir):
    root = daily_history(spark, sf_dir)
    names = history.catalog(history.snapshot_ids(spark, root))
    chosen = names.where(F.to_date("snapshot_ts") == F.lit("2024-01-15").cast("date")).first()
    return history.snapshot_at(spark, root, chosen.file_name).select("sku", "branch", "qty")


def snapshot_label(spark, sf_dir):
    return history.with_labels(day_catalog(spark, sf_dir))


def snapshot_name(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id", naming.snapshot_name(F.col("ts")).alias("name")
    )


def last_updated_text(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id", naming.last_updated_text(F.col("ts")).alias("last_updated")
    )


def json_roundtrip(spark, sf_dir):
    counts = events(spark, sf_dir).groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("n")
    )
    fields = T.StructType([
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("n", T.LongType()),
    ])
    text = F.to_json(F.struct("user_id", "event_type", "n"), {"ignoreNullFields": "false"})
    return counts.select(F.from_json(text, fields).alias("row")).select("row.*")


# -- queries on the dashboard -----------------------------------------------------------------


def rollup_selected(spark, sf_dir):
    return selected_totals(spark, sf_dir)


def sink_export(spark, sf_dir):
    path = new_path(spark, "export")
    documents.write_export(selected_totals(spark, sf_dir), path)
    return documents.read_export(spark, path)


def stock_band(spark, sf_dir):
    totals = selected_totals(spark, sf_dir, ("B0", "B3"))
    return serving.with_band(totals.select("sku", "qty"))


def stock_dashboard(spark, sf_dir):
    """Feed to banded totals of the chosen branches."""
    return serving.with_band(selected_totals(spark, sf_dir))


def dashboard_table(spark, sf_dir):
    """Second page of the SKUs with a 1 in their row, largest stock first."""
    view = dashboard.View(search="1", order_by="qty", descending=True, page_no=1, size=30)
    return dashboard.table(all_totals(spark, sf_dir), view)


def distinct_branches(spark, sf_dir):
    return serving.distinct_branches(snapshot(spark, sf_dir))


def branch_group(spark, sf_dir):
    branches = serving.distinct_branches(snapshot(spark, sf_dir))
    return branches.select(
        "branch", stock.branch_group(F.col("branch"), GROUPS).alias("branch_group")
    )


def branch_group_table(spark, sf_dir):
    rows = snapshot(spark, sf_dir).select("sku", "branch")
    return lookup.with_branch_group(rows, dimensions.branch_table(spark, GROUPS))


def snapshot_row() -> list[Column]:
    return [F.col("sku"), F.col("item"), F.col("branch")]


def search_rows(spark, sf_dir):
    found = serving.search(snapshot(spark, sf_dir), "B3 12", *snapshot_row())
    return found.select("sku", "item", "branch")


def search_table(spark, sf_dir):
    return serving.search(all_totals(spark, sf_dir), "12 .5", *serving.table_columns())


def table_info(spark, sf_dir):
    return serving.table_info(snapshot(spark, sf_dir), "B3", *snapshot_row())


def page_rows(spark, sf_dir):
    totals = all_totals(spark, sf_dir).select("sku", "qty")
    return serving.page(totals, 1, 30, [("sku", False)])


def page_far(spark, sf_dir):
    """The page is selected in several rounds, so the reconciliation behind it is staged."""
    totals = stage(all_totals(spark, sf_dir).select("sku", "qty"), "totals")
    return serving.page(totals, 20, 30, [("sku", False)])


def page_ties(spark, sf_dir):
    """A page deep among records with equal quantities, which the record's number tells apart."""
    records = stock_feed(spark, sf_dir).select("ord", F.floor("qty").alias("qty"))
    return serving.page(records, 25, 100, [("qty", True)])


def page_after(spark, sf_dir):
    totals = all_totals(spark, sf_dir).select("sku", "qty")
    return serving.page_after(totals, 30, [("qty", True), ("sku", False)], [90.0, "5"])


def page_all(spark, sf_dir):
    return serving.page(all_totals(spark, sf_dir).select("sku", "qty"), 0, None, [("sku", False)])


def number_rows(spark, sf_dir):
    skus = serving.rollup(snapshot(spark, sf_dir)).select("sku")
    return serving.number_rows(skus, F.col("sku"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        feed_scan_tagged, api_inline, api_documents, sheet_line_breaks, vend_positional, vend_whole, sheet_bad_width, hq_sheet,
        depot_sheet, feed_status,
        positional_projection, row_offset, drop_all_null, feed_union,
        hq_clean, depot_clean, na_normalise, cast_strict_int, cast_strict_double,
        prefix_until_bad, sku_alias_map,
        item_registry, resolve_by_item, resolve_by_sku, new_sku_entries,
        dropped_sku_name_clash, branch_last_wins, snapshot_reconcile, snapshot_ordered,
        snapshot_nested, explode_branches, nightly_run, mended_run, rerun_replaces, nightly_document,
        snapshot_read, snapshot_text_qty, import_documents, sink_latest, lost_race, swept_history, sink_history, sink_catalog, snapshot_catalog,
        latest_snapshot, snapshot_count, snapshot_at, snapshot_label, snapshot_name,
        last_updated_text, json_roundtrip,
        rollup_selected, sink_export, stock_band, stock_dashboard, dashboard_table,
        distinct_branches,
        branch_group, branch_group_table, search_rows, search_table, table_info, page_rows,
        page_far, page_ties, page_after, page_all, number_rows,
    )
}
