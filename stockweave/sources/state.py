"""What is known of landed files from earlier runs.

A file is known by its path, size and time, by the feed's spec and by the header that its feed is read
with: if any of them changes, it is another file. A *load* is what one run has read. It
keeps, for each of its files,

* ``rows``: the parsed records with their position in the file and their fate;
* ``digest``: first and last position and last quantity per key and branch;
* ``firsts``: the first position of each item and SKU;
* ``facts``: the number of rows, the first bad one, and the number of rows that are too wide.

All of these are about the file alone. Where it stands among the others, and hence the ordinals of
its records, is decided when files are put together. The ``manifest`` of a load, written last, says
which files it has.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, fields
from hashlib import sha256
from uuid import uuid4

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.functions.ordinal import position_bits
from stockweave.operators.projection import leading_cuts, skip_leading
from stockweave.sources import commits
from stockweave.sources.dimensions import small_table
from stockweave.sources.feeds import FeedSpec, LandedFile, layout_of, read_files
from stockweave.sources.staging import stage

#: Counts up when the meaning of the kept tables changes.
FORMAT = 1
WIDE_ROW = "a row with more cells than the header"
BAD, AFTER_BAD, NO_KEY, LEFT_OUT = "bad quantity", "after a bad quantity", "no item or SKU", ""

ROWS = (
    "load string, phase int, file bigint, position bigint, item string, sku string, branch string, "
    "qty double, bad boolean, fate string"
)
DIGEST = (
    "load string, phase int, file bigint, item string, sku string, branch string, first_position bigint, "
    "last_position bigint, qty double"
)
FIRSTS = "load string, phase int, file bigint, item string, sku string, position bigint"
FACTS = "load string, phase int, file bigint, n_rows bigint, first_bad bigint, wide_rows bigint"
MANIFEST = "load string, key string, phase int, file bigint"
TABLES = {"rows": ROWS, "digest": DIGEST, "firsts": FIRSTS, "facts": FACTS}


@dataclass(frozen=True)
class KnownFile:
    """A landed file, and where its state is."""

    landed: LandedFile
    load: str
    phase: int
    file: int


def fingerprint(spec: FeedSpec) -> str:
    """All that a spec says of how a file is read. The quantity's rule is told by its expression."""
    said = {f.name: getattr(spec, f.name) for f in fields(spec) if f.name not in ("quantity", "path", "required", "stores")}
    said |= {"aliases": sorted(spec.aliases.items()), "quantity": str(spec.quantity(F.col("cell"))), "format_": FORMAT}
    return json.dumps(said, sort_keys=True, default=str)


def keys_of(spec: FeedSpec, layout: tuple[str, ...], files: Sequence[LandedFile]) -> list[str]:
    """What each file is known by. The spec is told once: its expression is made in the JVM, which would
    take longer than all else if it were made for each file."""
    spec_told = fingerprint(spec)
    told = ([spec_told, layout, file.unit, file.uri, file.size, file.changed] for file in files)
    return [sha256(json.dumps(one).encode()).hexdigest() for one in told]


def _read(spark: SparkSession, root: str, name: str, layout: str) -> DataFrame:
    try:
        return spark.read.schema(layout).parquet(f"{root}/{name}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], layout)


def known_files(spark: SparkSession, root: str, keys: Sequence[str]) -> dict[str, tuple[str, int]]:
    """Load and number of the files which are known; one short row for each comes to the driver."""
    wanted = small_table(spark, {"key": pa.array(list(keys), pa.string())})
    found = _read(spark, root, "manifest", MANIFEST).join(wanted, "key").groupBy("key").agg(
        F.min(F.struct("load", "file")).alias("at")  # two runs at once may both have read it
    )
    return {row.key: (row["at"].load, row["at"].file) for row in found.collect()}


def _fate(spec: FeedSpec):
    """Why a row is no record: NULL if it is one, LEFT_OUT if that is nothing to report."""
    no_key = F.col("sku").isNull() | F.col("branch").isNull()
    if spec.item is not None:
        no_key = no_key | F.col("item").isNull()
    fate = F.when(F.col("wide"), WIDE_ROW)
    if spec.on_bad == "reject_row":
        fate = fate.when(F.col("bad"), BAD)
    elif spec.on_bad == "prefix":
        fate = fate.when(F.col("position") >= F.col("first_bad"), F.when(F.col("bad"), BAD).otherwise(AFTER_BAD))
    fate = fate.when(no_key, NO_KEY)
    return fate.when(~(F.col("qty") > 0), LEFT_OUT) if spec.positive_only else fate


def load_files(
    spark: SparkSession, root: str, spec: FeedSpec, layout: tuple[str, ...], files: dict[LandedFile, str]
) -> str:
    """Read files, given with their keys, and keep what there is to know of them; answers the load. A fault
    of any of them raises, and then none is known."""
    load = uuid4().hex
    parsed = stage(read_files(spark, spec, list(files), layout), spec.name)
    low_bits = (1 << position_bits(len(files))) - 1
    placed = parsed.withColumn("position", F.col("ord").bitwiseAND(F.lit(low_bits)))
    body = placed
    if spec.skip_rows:
        cuts = leading_cuts(placed, F.lit(spec.skip_rows), "position", "file")
        body = skip_leading(placed, cuts, "position", "file")
    if spec.drop_empty:
        body = body.where(~F.col("empty") | F.col("wide"))
    counts = placed.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"))
    faults = body.groupBy("file").agg(
        F.min(F.when(F.col("bad"), F.col("position"))).alias("first_bad"), F.count_if("wide").alias("wide_rows")
    )
    facts = stage(counts.join(faults, "file", "left").withColumn("wide_rows", F.coalesce("wide_rows", F.lit(0))), "facts")
    kept = body.join(facts.select("file", "first_bad"), "file").select(
        "file", "position", "item", "sku", "branch", "qty", "bad", _fate(spec).alias("fate")
    )
    _keep(kept, root, "rows", load, spec)
    # the records are read again from where they are kept now
    records = _read(spark, f"{root}/rows/load={load}", f"phase={spec.phase}", ROWS).where("fate IS NULL")
    names = [F.col("sku")] if spec.item is None else [F.col("item")]
    by_item, by_sku = (F.lit(None).cast("string"), names[0]) if spec.item is None else (names[0], F.lit(None).cast("string"))
    digest = records.groupBy("file", by_item.alias("item"), by_sku.alias("sku"), "branch").agg(
        F.min("position").alias("first_position"), F.max("position").alias("last_position"),
        F.max_by("qty", "position").alias("qty"),
    )
    _keep(digest, root, "digest", load, spec)
    if spec.item is not None:
        _keep(records.groupBy("file", "item", "sku").agg(F.min("position").alias("position")), root, "firsts", load, spec)
    _keep(facts, root, "facts", load, spec)
    manifest = small_table(spark, {
        "key": pa.array(list(files.values()), pa.string()),
        "file": pa.array(range(len(files)), pa.int64()),
    })
    _keep(manifest, root, "manifest", load, spec)
    return load


def _keep(table: DataFrame, root: str, name: str, load: str, spec: FeedSpec) -> None:
    table.write.parquet(f"{root}/{name}/load={load}/phase={spec.phase}")


def known_units(
    spark: SparkSession, root: str, spec: FeedSpec, files: list[LandedFile]
) -> list[KnownFile]:
    """The state of all ``files``, of which those that are not known yet are read first, in one scan."""
    layout = layout_of(spark, spec, [file.path for file in files])
    keys = dict(zip(files, keys_of(spec, layout, files), strict=True))
    known = known_files(spark, root, list(keys.values()))
    fresh = {file: key for file, key in keys.items() if key not in known}
    if fresh:
        load = load_files(spark, root, spec, layout, fresh)
        known |= {key: (load, number) for number, key in enumerate(fresh.values())}
    return [KnownFile(file, *known[keys[file]][:1], spec.phase, known[keys[file]][1]) for file in files]


def table_of(spark: SparkSession, root: str, name: str, files: Sequence[KnownFile]) -> DataFrame:
    """A kept table, with nothing but the loads of ``files`` listed and read."""
    layout = TABLES[name]
    loads = sorted({(file.load, file.phase) for file in files})
    paths = [f"{root}/{name}/load={load}/phase={phase}" for load, phase in loads]
    there = [path for path in paths if commits.exists(spark, path)]
    if not there:
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).option("basePath", f"{root}/{name}").parquet(*there)


def note_use(spark: SparkSession, root: str, files: Sequence[KnownFile]) -> None:
    """Note which loads the newest run has used."""
    loads = sorted({file.load for file in files})
    commits.commit(spark, f"{root}/log", json.dumps({"loads": loads}))
