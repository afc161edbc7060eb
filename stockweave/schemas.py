"""Table layouts shared by the readers, the reconciliation and the history."""

from __future__ import annotations

from pyspark.sql import types as T

#: One stock record after reading, before any row is dropped.
PARSED = T.StructType([
    T.StructField("phase", T.IntegerType()),
    T.StructField("unit", T.StringType()),
    T.StructField("file", T.LongType()),
    T.StructField("ord", T.LongType()),
    T.StructField("item", T.StringType()),
    T.StructField("sku", T.StringType()),
    T.StructField("branch", T.StringType()),
    T.StructField("qty", T.DoubleType()),
    T.StructField("bad", T.BooleanType()),
    T.StructField("empty", T.BooleanType()),
    T.StructField("wide", T.BooleanType()),
])

#: One clean stock record; ``ord`` is unique and has the phase as its highest part.
FEED = T.StructType([
    T.StructField("phase", T.IntegerType()),
    T.StructField("ord", T.LongType()),
    T.StructField("item", T.StringType()),
    T.StructField("sku", T.StringType()),
    T.StructField("branch", T.StringType()),
    T.StructField("qty", T.DoubleType()),
])

REJECTS = T.StructType([
    T.StructField("phase", T.IntegerType()),
    T.StructField("ord", T.LongType()),
    T.StructField("item", T.StringType()),
    T.StructField("sku", T.StringType()),
    T.StructField("branch", T.StringType()),
    T.StructField("reason", T.StringType()),
])

#: What became of a unit of a feed.
FEED_STATUS = T.StructType([
    T.StructField("feed", T.StringType()),
    T.StructField("phase", T.IntegerType()),
    T.StructField("unit", T.StringType()),
    T.StructField("required", T.BooleanType()),
    T.StructField("status", T.StringType()),
    T.StructField("detail", T.StringType()),
    T.StructField("n_rows", T.LongType()),
])

#: Long form of a snapshot: one row per SKU and branch.
SNAPSHOT = T.StructType([
    T.StructField("sku", T.StringType()),
    T.StructField("item", T.StringType()),
    T.StructField("branch", T.StringType()),
    T.StructField("qty", T.DoubleType()),
    T.StructField("entry_ord", T.LongType()),
])

#: One SKU of a snapshot document. The branch names are data, so they are map keys; the quantities
#: are read as they are spelled.
DOCUMENT_ENTRY = T.StructType([
    T.StructField("Item", T.StringType()),
    T.StructField("SKU", T.StringType()),
    T.StructField("Branch", T.MapType(T.StringType(), T.StringType())),
])

#: A document; a large snapshot has several, numbered from 1. Older ones have no numbers.
SNAPSHOT_DOCUMENT = T.StructType([
    T.StructField("last_updated", T.StringType()),
    T.StructField("part", T.LongType()),
    T.StructField("parts", T.LongType()),
    T.StructField("inventory", T.ArrayType(DOCUMENT_ENTRY)),
])

#: Product list as the online shop hands it out.
PRODUCT_LIST = T.StructType([
    T.StructField("list", T.ArrayType(T.StructType([
        T.StructField("sku", T.StringType()),
        T.StructField("availablestock", T.StringType()),
    ]))),
])


def with_version(layout: T.StructType) -> T.StructType:
    """A report as it is kept: by snapshot and version of the run."""
    keys = [T.StructField(name, T.StringType()) for name in ("version", "snapshot_id")]
    return T.StructType([*layout.fields, *keys])
