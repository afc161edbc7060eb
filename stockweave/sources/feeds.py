"""Landed feeds.

A feed is a folder or file which some other job has fetched. The readers tag every row with its
phase, unit (the part of a feed which stands or falls together) and ordinal, and type the quantity
by the feed's rule. They drop nothing: what to skip or reject is decided on the staged rows.

Text files are split like any other. A cell must not hold a line break unless the spec says so
(``multi_line``); then what ends a record is found by a scan over all blocks of the file, and so are the
entries of a product list that is one document. A row with more cells than its header is marked ``wide``:
its cells may stand in the wrong columns. A shorter row lacks its last cells.
"""

from __future__ import annotations

import csv
import json
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from urllib.parse import unquote

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockweave import fixed_values as fixed
from stockweave.functions import casting
from stockweave.functions.ordinal import ordinal, parquet_position, row_in_task, text_position
from stockweave.operators.lookup import canonical_sku
from stockweave.operators.projection import quoted
from stockweave.schemas import PARSED, PRODUCT_LIST
from stockweave.sources.dimensions import alias_table, small_table
from stockweave.sources.splitting import MalformedDocument, csv_records, json_elements
from stockweave.sources.staging import stage


#: What the text of an error names if the files, and not the cluster, are at fault.
FILE_FAULTS = (
    "CSV header does not conform", "Number of column in CSV header is not equal",
    "MALFORMED_RECORD", "MALFORMED_CSV_RECORD", "PATH_NOT_FOUND",
    "UNABLE_TO_INFER_SCHEMA", "CANNOT_MERGE_SCHEMAS", "PARQUET_COLUMN_DATA_TYPE_MISMATCH",
    "is not a Parquet file",
)
#: Under which key a product list stands.
LIST_KEY = "list"
#: Holds the text of a row whose cells do not match the header.
ODD_ROW = "_odd_row"


class FeedError(Exception):
    """A feed which cannot be read."""


@dataclass(frozen=True)
class FeedSpec:
    """Where a feed lies and how to read it.

    ``item``, ``sku``, ``qty`` and ``branch_column`` name columns, or give their position.
    ``quantity`` is the rule for the quantity: it answers NULL for a bad cell, or raises.
    ``on_bad`` says what a bad cell costs: ``prefix`` the rest of the unit, ``reject_row`` the row;
    ``never`` is for rules which leave no bad cell.
    """

    name: str
    phase: int
    path: str
    required: bool
    quantity: Callable[[Column], Column]
    sku: str | int
    qty: str | int
    item: str | int | None = None
    branch: str | None = None
    branch_column: str | int | None = None
    stores: tuple[str, ...] = ()
    format: str = "csv"
    header: bool = True
    multi_line: bool = False
    skip_rows: int = 0
    drop_empty: bool = False
    positive_only: bool = False
    on_bad: str = "never"
    aliases: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class LandedFile:
    """A file of a unit, as the storage lists it."""

    unit: str
    uri: str
    path: str
    size: int
    changed: int


@dataclass(frozen=True)
class UnitStatus:
    feed: str
    phase: int
    unit: str
    required: bool
    status: str
    detail: str = ""


#: How a workbook's quantity cells landed: as numbers, or as the text which they were.
INTEGER_RULES = {
    "numeric": casting.strict_int_from_number,
    "text": casting.strict_int_from_text,
}


def pos_feed(path: str, stores=fixed.STORES, qty_cells: str = "numeric", **options) -> FeedSpec:
    """Store tables, one folder ``branch=<store>`` each; a bad quantity ends its store."""
    defaults = dict(
        name="pos", phase=1, path=path, required=False, stores=tuple(stores),
        quantity=INTEGER_RULES[qty_cells], on_bad="prefix",
        item=fixed.STORE_ITEM, sku=fixed.STORE_SKU, qty=fixed.STORE_QTY,
    )
    return FeedSpec(**(defaults | options))


def api_feed(path: str, branch: str = fixed.ONLINE_BRANCH, **options) -> FeedSpec:
    """Product lists of the online shop, one document per file; a bad quantity ends the run."""
    defaults = dict(
        name="api", phase=2, path=path, required=True, branch=branch, format="json",
        multi_line=True,
        quantity=lambda cell: casting.require_double(cell, "online shop"),
        sku="sku", qty="availablestock",
    )
    return FeedSpec(**(defaults | options))


def vend_feed(path: str, qty_cells: str = "numeric", **options) -> FeedSpec:
    """Vending machine table: two title lines and a header; a bad quantity ends the feed."""
    defaults = dict(
        name="vend", phase=3, path=path, required=False,
        quantity=INTEGER_RULES[qty_cells], on_bad="prefix",
        branch_column=2, sku=3, qty=7, header=False, skip_rows=3, drop_empty=True,
    )
    return FeedSpec(**(defaults | options))


def hq_feed(path: str, branch: str = fixed.HQ_BRANCH, **options) -> FeedSpec:
    """Head office sheet: two lines after the header are skipped, only positive stock counts."""
    defaults = dict(
        name="hq", phase=4, path=path, required=True, branch=branch,
        quantity=casting.coerced_int, sku=2, item=3, qty=7, skip_rows=2, positive_only=True,
    )
    return FeedSpec(**(defaults | options))


def depot_feed(path: str, branch: str = fixed.DEPOT_BRANCH, **options) -> FeedSpec:
    """Depot sheet: SKUs are renamed, a bad quantity ends the run."""
    defaults = dict(
        name="depot", phase=5, path=path, required=True, branch=branch,
        quantity=lambda cell: casting.require_int(cell, "depot"),
        sku=1, item=2, qty=6, aliases=fixed.DEPOT_SKU_ALIASES,
    )
    return FeedSpec(**(defaults | options))


def is_file_fault(error: Exception) -> bool:
    """Whether the landed files are to blame. Lost executors, full disks and missing rights are not
    a feed's fault, and must not pass for one."""
    if isinstance(error, FeedError):
        return True
    known = isinstance(error, (PySparkException, Py4JError))
    return known and any(fault in str(error) for fault in FILE_FAULTS)


def _path_utils(spark: SparkSession):
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils


def folder_of(spark: SparkSession, spec: FeedSpec, unit: str) -> str:
    """Folder of a unit; a store's name is escaped as Spark's writers do it."""
    if not spec.stores:
        return spec.path
    return f"{spec.path}/branch={_path_utils(spark).escapePathName(unit)}"


def store_of(spark: SparkSession, path: str) -> str:
    """Store of a listed file: the inverse of :func:`folder_of`, of which paths are URIs."""
    folder = unquote(path).rsplit("/branch=", 1)[1].split("/", 1)[0]
    return _path_utils(spark).unescapePathName(folder)


def landed_units(spark: SparkSession, spec: FeedSpec) -> tuple[list[str], list[str]]:
    """Units of a feed which have landed, in reading order, and those which have not.

    Only the folders of the configured stores are looked at, whatever else there is.
    """
    if not spec.stores:
        return [spec.name], []
    landed = [unit for unit in spec.stores if _has_files(spark, folder_of(spark, spec, unit))]
    return landed, [unit for unit in spec.stores if unit not in landed]


def _has_files(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return False
    return any(not f.getPath().getName().startswith(("_", ".")) for f in files.listStatus(path))


def _first_file(spark: SparkSession, folder: str) -> str | None:
    """Any one data file of a folder; the listing stops at it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return None
    found = files.listFiles(path, True)
    while found.hasNext():
        file = found.next().getPath()
        if not file.getName().startswith(("_", ".")):
            return file.toString()
    return None


def landed_files(spark: SparkSession, spec: FeedSpec, units: list[str]) -> list[LandedFile]:
    """The data files of units in reading order; the listing holds no data.

    Folders are listed one by one: a recursive listing with block locations starts a process for each
    file of a local disk.
    """
    found = []
    for unit in units:
        root = spark._jvm.org.apache.hadoop.fs.Path(folder_of(spark, spec, unit))
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            continue
        hidden = ("_", ".") if files.getFileStatus(root).isDirectory() else ()
        of_unit, folders = [], [root]
        while folders:
            for status in files.listStatus(folders.pop()):
                path = status.getPath()
                if path.getName().startswith(hidden):
                    continue
                if status.isDirectory():
                    folders.append(path)
                    continue
                of_unit.append(LandedFile(
                    unit, path.toUri().toString(), path.toString(), status.getLen(), status.getModificationTime()
                ))
        found += sorted(of_unit, key=lambda file: file.uri)
    return found


def _literal(path: str) -> str:
    """A path as a pattern that fits just itself."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def header_of(spark: SparkSession, spec: FeedSpec, folder: str) -> tuple[str, ...]:
    """Column names of a text feed, from the first line of one of its files."""
    file = _first_file(spark, folder)
    if file is None:
        raise FeedError(f"{spec.name}: no files")
    options = dict(header=spec.header, escape='"', multiLine=spec.multi_line)
    return tuple(spark.read.options(**options).csv(_literal(file)).columns)


def by_header(spark: SparkSession, spec: FeedSpec, units: list[str]) -> list[list[str]]:
    """Units in groups with one header each, for a feed which cannot be read in one scan."""
    if spec.format != "csv" or not spec.stores:
        return [[unit] for unit in units]
    found: dict[tuple, list[str]] = {}
    for unit in units:
        header = header_of(spark, spec, folder_of(spark, spec, unit))
        found.setdefault(header, []).append(unit)
    return list(found.values())


def layout_of(spark: SparkSession, spec: FeedSpec, paths: list[str]) -> tuple[str, ...]:
    """What the reader takes from the files before it reads them: the header of a text feed, the merged
    schema of Parquet files."""
    if spec.format == "csv":
        return header_of(spark, spec, paths[0])
    if spec.format == "parquet":
        paths = [_literal(path) for path in paths]
        merged = spark.read.option("recursiveFileLookup", True).option("mergeSchema", len(paths) > 1).parquet(*paths)
        return (merged.schema.json(),)
    return ()


def read_table(
    spark: SparkSession, spec: FeedSpec, paths: list[str], layout: tuple[str, ...] | None = None
) -> DataFrame:
    """A landed table: ``_path``, ``_position``, ``_wide`` and then its own columns, text still as
    text. ``layout`` is that of :func:`layout_of` if the paths are but a part of the feed."""
    if spec.multi_line and spec.format != "parquet":
        return _read_split(spark, spec, paths, layout)
    reader = spark.read.option("recursiveFileLookup", True)
    position, wide = text_position, F.lit(False)
    if spec.format == "parquet":
        if layout is None:
            reader = reader.option("mergeSchema", len(paths) > 1)
        else:
            reader = reader.schema(T.StructType.fromJson(json.loads(layout[0])))
        table = reader.parquet(*paths)
        position = parquet_position
    elif spec.format == "json":
        documents = (
            reader.schema(PRODUCT_LIST).option("mode", "FAILFAST").json(paths)
        )
        _require_files(documents, spec)
        table = documents.select("_metadata", F.inline("list"))
    else:
        # Columns chosen by name have to stand in the same place in all files; a file with
        # another header is an error. Columns chosen by position may be named at will.
        names = header_of(spark, spec, paths[0]) if layout is None else layout
        cells = [T.StructField(name, T.StringType()) for name in [*names, ODD_ROW]]
        table = (
            reader.schema(T.StructType(cells)).option("header", spec.header)
            .option("enforceSchema", isinstance(spec.sku, int))
            .option("escape", '"')
            .option("columnNameOfCorruptRecord", ODD_ROW)
            .option("columnPruning", False)  # else the cells of a row are not counted
            .csv(paths)
        )
        wide = _is_wide(F.col(ODD_ROW), len(names))
    _require_files(table, spec)
    own = [quoted(name) for name in table.columns if name not in ("_metadata", ODD_ROW)]
    counted = table.select(
        F.col("_metadata").alias("_file"), row_in_task().alias("_row"), wide.alias("_wide"), *own
    )
    file = F.col("_file")
    return counted.select(
        file["file_path"].alias("_path"), position(file, F.col("_row")).alias("_position"),
        "_wide", *own,
    )


def _read_split(
    spark: SparkSession, spec: FeedSpec, paths: list[str], layout: tuple[str, ...] | None
) -> DataFrame:
    """A landed table whose records may hold line breaks, or are one list: split by many tasks."""
    try:
        if spec.format == "json":
            elements = json_elements(spark, paths, LIST_KEY)
            entry = PRODUCT_LIST[LIST_KEY].dataType.elementType
            parsed = elements.select("*", F.from_json("value", entry, {"mode": "FAILFAST"}).alias("_entry"))
            return parsed.select(
                F.col("path").alias("_path"), F.col("begin").alias("_position"), F.lit(False).alias("_wide"), "_entry.*"
            )
        names = header_of(spark, spec, paths[0]) if layout is None else layout
        records = csv_records(spark, paths)
        if spec.header:
            records = _without_header(spec, records, names)
    except MalformedDocument as error:
        raise FeedError(f"{spec.name}: {error}") from error
    cells = [f"c{n}" for n in range(len(names))]
    layout_text = ", ".join(f"{cell} STRING" for cell in [*cells, ODD_ROW])
    options = {"escape": '"', "columnNameOfCorruptRecord": ODD_ROW}
    parsed = records.select("*", F.from_csv("value", layout_text, options).alias("_cells"))
    return parsed.select(
        F.col("path").alias("_path"), F.col("begin").alias("_position"),
        _is_wide(F.col(f"_cells.{ODD_ROW}"), len(names)).alias("_wide"),
        *[F.col(f"_cells.{cell}").alias(name) for cell, name in zip(cells, names, strict=True)],
    )


def _without_header(spec: FeedSpec, records: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Records without the first one of each file. Where columns are chosen by name, it has to be the
    header that the feed is read with."""
    first = stage(records.groupBy("path").agg(
        F.min("begin").alias("_first"), F.min_by("value", "begin").alias("_header")), "headers")
    if not isinstance(spec.sku, int):
        expected = [name.lower() for name in names]
        for row in first.select("_header").distinct().collect():
            found = [cell.lower() for cell in next(csv.reader([row._header]))]
            if found != expected:
                raise FeedError(f"{spec.name}: CSV header does not conform: {row._header}")
    return records.join(first.drop("_header"), "path").where("begin > _first").drop("_first")


def _is_wide(odd_row: Column, width: int) -> Column:
    """Whether the text of an odd row has more cells than the header: too many commas outside of
    quotes. Spark notes shorter rows as odd, too."""
    bare = F.regexp_replace(odd_row, '"([^"]|"")*"', "")
    commas = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))
    return F.coalesce(commas >= width, F.lit(False))


def read_units(
    spark: SparkSession, spec: FeedSpec, units: list[str], among: list[str] | None = None
) -> DataFrame:
    """Parsed rows of units of a feed, in one scan. Files are numbered ``among`` those of all these
    units, if the feed is read in several scans."""
    table = _table(spark, spec, [folder_of(spark, spec, unit) for unit in units])
    if among is not None and among != units:
        numbered = _tagged(table, [(file.unit, file.uri) for file in landed_files(spark, spec, among)])
    else:
        numbered = _with_file_number(table, spec, units)
    return _parsed(table, spec, *numbered)


def read_files(
    spark: SparkSession, spec: FeedSpec, files: list[LandedFile], layout: tuple[str, ...]
) -> DataFrame:
    """Parsed rows of some files of a feed, in one scan; ``file`` is their place in the list."""
    paths = [_literal(file.path) for file in files]
    table = _table(spark, spec, paths, layout)
    return _parsed(table, spec, *_tagged(table, [(file.unit, file.uri) for file in files]))


def _table(spark: SparkSession, spec: FeedSpec, paths: list[str], layout=None) -> DataFrame:
    try:
        return read_table(spark, spec, paths, layout)
    except AnalysisException as error:
        if not is_file_fault(error):
            raise
        raise FeedError(f"{spec.name}: {error.getCondition()}") from error


def _parsed(table: DataFrame, spec: FeedSpec, numbered: DataFrame, files: int) -> DataFrame:
    spark, columns = table.sparkSession, table.columns[3:]
    text = spec.format == "csv"
    cells = {
        name: None if which is None else _cell(spec, columns, which, text)
        for name, which in (
            ("item", spec.item), ("sku", spec.sku), ("qty", spec.qty),
            ("branch", spec.branch_column),
        )
    }
    item = F.lit(None).cast("string") if cells["item"] is None else cells["item"]
    fixed_branch = F.col("_unit") if spec.stores else F.lit(spec.branch)
    branch = fixed_branch if cells["branch"] is None else cells["branch"]
    empty = F.lit(False)
    if spec.drop_empty:
        empty = F.coalesce(*[_cell(spec, columns, name, text) for name in columns]).isNull()
    parsed = (
        numbered.select(
            F.lit(spec.phase).alias("phase"),
            F.col("_unit").alias("unit"),
            F.col("_file").cast("bigint").alias("file"),
            ordinal(spec.phase, F.col("_file"), F.col("_position"), files).alias("ord"),
            item.alias("item"),
            cells["sku"].alias("sku"),
            branch.alias("branch"),
            F.when(~F.col("_wide"), spec.quantity(cells["qty"])).cast("double").alias("qty"),
            empty.alias("empty"),
            F.col("_wide").alias("wide"),
        )
        .withColumn("bad", F.col("qty").isNull() & ~F.col("empty") & ~F.col("wide"))
    )
    if spec.aliases:
        parsed = canonical_sku(parsed, alias_table(spark, spec.aliases))
    return parsed.select(*PARSED.names)


def status_of(spec: FeedSpec, unit: str, status: str, detail: str = "") -> UnitStatus:
    return UnitStatus(spec.name, spec.phase, unit, spec.required, status, detail)


def _cell(spec: FeedSpec, columns: list[str], which: str | int, words: bool) -> Column:
    if isinstance(which, int):
        if which >= len(columns):
            raise FeedError(f"{spec.name}: no column at position {which}")
        which = columns[which]
    if which not in columns:
        raise FeedError(f"{spec.name}: no column {which}")
    value = quoted(which).cast("string")
    return casting.na_to_null(value) if words else value


def _require_files(df: DataFrame, spec: FeedSpec) -> None:
    if not df.columns or not df.inputFiles():
        raise FeedError(f"{spec.name}: no files")


def _with_file_number(
    table: DataFrame, spec: FeedSpec, units: list[str]
) -> tuple[DataFrame, int]:
    """Number the files by unit and name, and tag the rows with their unit.

    The scan has its list of files on the driver anyway; it holds no data. The table made of it has
    a known size, by which the optimizer chooses the join.
    """
    spark = table.sparkSession
    if spec.multi_line and spec.format != "parquet":  # the table is made of staged pieces of the files
        return _tagged(table, [(file.unit, file.uri) for file in landed_files(spark, spec, units)])
    files = table.inputFiles()
    if spec.stores:
        order = {unit: n for n, unit in enumerate(units)}
        tagged = sorted((order[store_of(spark, path)], path) for path in files)
    else:
        tagged = sorted((0, path) for path in files)
    return _tagged(table, [(units[unit], path) for unit, path in tagged])


def _tagged(table: DataFrame, files: list[tuple[str, str]]) -> tuple[DataFrame, int]:
    """Tag the rows with the unit and the place of their file in a list of (unit, URI)."""
    if len(files) == 1:
        tags = F.lit(0).alias("_file"), F.lit(files[0][0]).alias("_unit")
        return table.select("*", *tags), 1
    numbers = small_table(table.sparkSession, {
        "_plain": pa.array([_plain(path) for _, path in files], pa.string()),
        "_number": pa.array(range(len(files)), pa.int64()),
        "_unit": pa.array([unit for unit, _ in files], pa.string()),
    })
    known = F.coalesce(
        F.col("_number"), F.raise_error(F.concat(F.lit("unlisted file "), "_path")).cast("bigint")
    )
    plain = F.regexp_replace("_path", ":/+", ":/")
    numbered = table.withColumn("_plain", plain).join(numbers, "_plain", "left").drop("_plain")
    return numbered.withColumn("_file", known), len(files)


def _plain(path: str) -> str:
    """A path without host is spelled file:/x or file:///x: here with one slash."""
    return re.sub(":/+", ":/", path)
