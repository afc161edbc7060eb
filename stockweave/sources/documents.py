"""Snapshot documents and table exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.functions import casting, naming
from stockweave.operators.reconcile import document_entries
from stockweave.operators.serving import number_rows
from stockweave.schemas import SNAPSHOT_DOCUMENT
from stockweave.sources import history
from stockweave.sources.staging import stage

SKUS_PER_DOCUMENT = 5_000


class IncompleteSnapshot(Exception):
    """Parts of a snapshot are missing among its documents."""


def snapshot_documents(
    snapshot: DataFrame, last_updated: Column, skus_per_document: int = SKUS_PER_DOCUMENT
) -> DataFrame:
    """The snapshot as documents of limited size, in sequence, SKUs in the order of their entries.

    One array for all SKUs would have to pass through one task, so a large snapshot becomes
    several documents, each of which says which part of how many it is. A snapshot without rows is
    one document with an empty inventory. The rows are dealt to ranges of parts before they are put
    together: to sort the documents would make each of them twice, once for the sort's sample.
    """
    entries = number_rows(document_entries(snapshot), F.col("entry_ord"))
    skus = entries.agg(F.max("row_no")).first()[0] or 0
    parts = max(1, -(-skus // skus_per_document))
    part = F.floor((F.col("row_no") - 1) / skus_per_document) + 1
    in_order = F.sort_array(F.collect_list(F.struct("entry_ord", "Item", "SKU", "pairs")))
    inventory = F.transform(in_order, lambda row: F.struct(
        row["Item"].alias("Item"), row["SKU"].alias("SKU"),
        F.map_from_entries(row["pairs"]).alias("Branch"),
    ))
    filled = entries.withColumn("part", part).repartitionByRange("part").groupBy("part").agg(
        inventory.alias("inventory")
    )
    if not skus:  # else every part has SKUs
        nothing = F.array().cast(filled.schema["inventory"].dataType)
        filled = snapshot.sparkSession.range(1, 2).select(F.col("id").alias("part"), nothing.alias("inventory"))
    body = F.struct(last_updated.alias("last_updated"), "part", F.lit(parts).alias("parts"), "inventory")
    return filled.sortWithinPartitions("part").select("part", F.to_json(body).alias("value"))


def write_documents(
    snapshot: DataFrame, path: str, last_updated: Column,
    skus_per_document: int = SKUS_PER_DOCUMENT,
) -> None:
    """One compact document per line, in sequence over the files."""
    documents = snapshot_documents(snapshot, last_updated, skus_per_document)
    documents.select("value").write.text(path)


def read_entries(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """SKU rows of snapshot documents: file_name, last_updated, part, place, sku, item, branches.

    ``file_name`` is that of the snapshot: of the folder which is named like one, else of the folder
    that holds the parts, else of the file.
    ``multi_line`` reads files which hold a single document, with or without line breaks. A broken
    document fails the query, and so does a snapshot of which a part is missing. Quantities count
    as far as they start with a number, and as NaN if they do not.
    """
    folder = F.regexp_extract("_metadata.file_path", r"/(?:[^/=]+=)?([^/=]+\.json)/(?:[^/]+/)?[^/]+$", 1)
    holder = F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1)
    plain = F.when(F.col("parts").isNotNull(), holder).otherwise(F.col("_metadata.file_name"))
    name = F.coalesce(F.nullif(folder, F.lit("")), plain)
    documents = stage(
        spark.read.schema(SNAPSHOT_DOCUMENT).option("multiLine", multi_line)
        .option("mode", "FAILFAST").option("recursiveFileLookup", True).json(path)
        .select("*", name.alias("file_name")),
        "documents",
    )
    _require_all_parts(documents)
    quantities = F.transform_values("entry.Branch", lambda _, text: casting.leading_number(text))
    return documents.select(
        "file_name", "last_updated", F.coalesce("part", F.lit(1)).alias("part"),
        F.posexplode("inventory").alias("place", "entry"),
    ).select(
        "file_name", "last_updated", "part", "place", F.col("entry.SKU").alias("sku"),
        F.col("entry.Item").alias("item"), quantities.alias("branches"),
    )


def _require_all_parts(documents: DataFrame) -> None:
    broken = (
        documents.where("parts is not null").groupBy("file_name")
        .agg(F.count_distinct("part").alias("found"), F.max("parts").alias("parts"))
        .where("found <> parts").first()
    )
    if broken is not None:
        raise IncompleteSnapshot(f"{broken.file_name}: {broken.found} of {broken.parts} parts")


def read_documents(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """SKU rows of the documents of one snapshot: last_updated, sku, item, branches."""
    return read_entries(spark, path, multi_line).select("last_updated", "sku", "item", "branches")


def import_documents(spark: SparkSession, path: str, root: str, multi_line: bool = True) -> None:
    """Append the snapshots of a folder of documents to a history.

    Each file, or folder of parts, is the snapshot that its name says; other names are left out.
    SKUs keep the order of their document. A document without any quantity is an empty snapshot.
    """
    entries = read_entries(spark, path, multi_line)
    stamp = naming.snapshot_ts(F.col("file_name"))
    rows = entries.select(
        "sku", "item", F.explode("branches").alias("branch", "qty"),
        (F.col("part") * F.lit(1 << 32) + F.col("place")).alias("entry_ord"),
        stamp.alias("snapshot_ts"),
    ).where("snapshot_ts is not null")
    # a document with an empty inventory has no entries, so the names are listed
    names = history.file_names(spark, path)
    stamps = history.catalog(names).select("snapshot_ts")
    history.append_snapshots(rows, root, stamps)


def write_export(totals: DataFrame, path: str) -> None:
    """The table as CSV with the columns SKU, Item, Qty."""
    totals.select(
        F.col("sku").cast("string").alias("SKU"), F.col("item").alias("Item"),
        F.col("qty").alias("Qty"),
    ).write.option("header", True).option("escape", '"').csv(path)


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """An export with SKUs as text, leading zeros included."""
    exported = (
        spark.read.schema("SKU string, Item string, Qty double")
        .option("header", True).option("enforceSchema", False).option("escape", '"').csv(path)
    )
    return exported.toDF("sku", "item", "qty")
