"""A nightly run that reads just the files which changed.

What earlier runs know of a landed file is kept (see :mod:`stockweave.sources.state`). A run lists the
landed files, reads those that are new or not the same any more, and puts the digests of all
files together: the first of the first records, the last of the last quantities. Which files count
is decided here, from one row of facts for each: a bad quantity ends its unit in all later files, a
row that is too wide fails its unit. The result is that of a run which reads everything.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.functions.ordinal import PHASE_SHIFT, position_bits
from stockweave.operators.reconcile import (
    ITEM_PHASES, Reconciliation, first_of_items, merged_digest, reconcile_reduced,
)
from stockweave.plans.nightly import CleanFeed, error_text, feed_status, union
from stockweave.schemas import FEED, REJECTS
from stockweave.sources import state
from stockweave.sources.dimensions import small_table
from stockweave.sources.feeds import (
    FeedError, FeedSpec, LandedFile, UnitStatus, by_header, is_file_fault, landed_files,
    landed_units, status_of,
)
from stockweave.sources.state import KnownFile, table_of


@dataclass(frozen=True)
class PlacedFile:
    """A known file with its place among the files of its feed. ``whole`` is False for a file after a
    bad quantity of its unit, which has no records."""

    known: KnownFile
    base: int
    limit: int
    whole: bool


def known_feed(
    spark: SparkSession, root: str, spec: FeedSpec
) -> tuple[list[KnownFile], list[LandedFile], dict[str, UnitStatus]]:
    """The files of a feed with their state, all that have landed, and what became of its units.

    Files that cannot be read end a required feed; of an optional one those units are lost whose
    header the others do not share or whose files are broken.
    """
    landed, missing = landed_units(spark, spec)
    if missing and spec.required:
        raise FeedError(f"{spec.name}: no files for {missing}")
    states = {unit: status_of(spec, unit, "failed", "no files") for unit in missing}
    listed = landed_files(spark, spec, landed)
    found, groups = {}, [landed] if landed else []
    while groups:
        units = groups.pop(0)
        try:
            files = [file for file in listed if file.unit in units]
            if not files:
                raise FeedError(f"{spec.name}: no files")
            for known in state.known_units(spark, root, spec, files):
                found.setdefault(known.landed.unit, []).append(known)
            states |= {unit: status_of(spec, unit, "read") for unit in units}
        except (FeedError, PySparkException, Py4JError) as error:
            if spec.required or not is_file_fault(error):
                raise
            smaller = by_header(spark, spec, units) if len(units) > 1 else []
            groups += [[unit] for unit in units] if len(smaller) == 1 else smaller
            if not smaller:
                states |= {units[0]: status_of(spec, units[0], "failed", error_text(error))}
    return [known for unit in landed for known in found.get(unit, [])], listed, states


def place_files(
    spec: FeedSpec, files: Sequence[KnownFile], landed: Sequence[LandedFile], facts: dict,
    states: dict[str, UnitStatus],
) -> list[PlacedFile]:
    """The files that count, in their order, by what is known of each: (rows, first bad row, too wide
    rows). They are numbered among all ``landed`` ones. Units with a row too wide fail, unless such
    rows are rejected singly."""
    strict = spec.on_bad != "reject_row"
    wide = {file.landed.unit for file in files if strict and facts[file][2]}
    if wide and spec.required:
        raise FeedError(f"{spec.name}: {state.WIDE_ROW}")
    states |= {unit: status_of(spec, unit, "failed", state.WIDE_ROW) for unit in wide}
    bits = position_bits(len(landed))
    numbers = {file.uri: number for number, file in enumerate(landed)}
    placed, ended = [], set()
    for file in files:
        unit, number = file.landed.unit, numbers[file.landed.uri]
        if unit in wide:
            continue
        base = (spec.phase << PHASE_SHIFT) + (number << bits)
        placed.append(PlacedFile(file, base, 1 << bits, unit not in ended))
        if spec.on_bad == "prefix" and facts[file][1] is not None:
            ended.add(unit)
    return placed


def read_facts(spark: SparkSession, root: str, files: Sequence[KnownFile]) -> dict:
    """Rows, first bad row and too wide rows of each file: one short row each, on the driver, where the
    files are listed anyway."""
    found = {
        (row.load, row.phase, row.file): (row.n_rows, row.first_bad, row.wide_rows)
        for row in table_of(spark, root, "facts", files).collect()
    }
    return {file: found.get((file.load, file.phase, file.file), (0, None, 0)) for file in files}


def _placed_table(spark: SparkSession, placed: Sequence[PlacedFile]) -> DataFrame:
    return small_table(spark, {
        "load": pa.array([p.known.load for p in placed], pa.string()),
        "phase": pa.array([p.known.phase for p in placed], pa.int32()),
        "file": pa.array([p.known.file for p in placed], pa.int64()),
        "base": pa.array([p.base for p in placed], pa.int64()),
        "limit": pa.array([p.limit for p in placed], pa.int64()),
        "whole": pa.array([p.whole for p in placed], pa.bool_()),
    })


def _ord(position: str) -> Column:
    fits = F.col(position) < F.col("limit")
    failed = F.raise_error(F.lit("files and positions do not fit the ordinal")).cast("bigint")
    return F.col("base") + F.when(fits, F.col(position)).otherwise(failed)


def read_known(
    spark: SparkSession, specs: Sequence[FeedSpec], root: str
) -> tuple[CleanFeed, Reconciliation]:
    """The clean feed and its reconciliation, of which only files that changed are read anew."""
    specs = sorted(specs, key=lambda spec: spec.phase)
    files, listed, states = {}, {}, {}
    for spec in specs:
        files[spec.name], listed[spec.name], states[spec.name] = known_feed(spark, root, spec)
    every = [file for spec in specs for file in files[spec.name]]
    facts = read_facts(spark, root, every)
    placed = [
        p for spec in specs
        for p in place_files(spec, files[spec.name], listed[spec.name], facts, states[spec.name])
    ]
    places = _placed_table(spark, placed)
    at = ["load", "phase", "file"]
    known = [p.known for p in placed]

    rows = table_of(spark, root, "rows", known).join(places, at).withColumn("ord", _ord("position"))
    reason = (
        F.when(F.col("whole"), F.col("fate"))
        .when(F.col("bad"), state.BAD).otherwise(state.AFTER_BAD)
    )
    records = rows.where("whole AND fate IS NULL").select(*FEED.names)
    rejects = rows.withColumn("reason", reason).where(F.col("reason") != state.LEFT_OUT).select(*REJECTS.names)
    whole = places.where("whole")
    digest = table_of(spark, root, "digest", known).join(whole, at).select(
        "phase", "item", "sku", "branch", _ord("first_position").alias("first_ord"),
        _ord("last_position").alias("last_ord"), "qty",
    )
    firsts = table_of(spark, root, "firsts", known).join(whole, at).select(
        "item", "sku", _ord("position").alias("ord"), "phase"
    ).where(F.col("phase").isin(*ITEM_PHASES))
    reconciled = reconcile_reduced(records, merged_digest(digest), first_of_items(firsts))

    counts: dict[tuple[int, str], int] = {}
    for file in every:
        unit = file.phase, file.landed.unit
        counts[unit] = counts.get(unit, 0) + facts[file][0]
    counted = small_table(spark, {
        "phase": pa.array([phase for phase, _ in counts], pa.int32()),
        "unit": pa.array([unit for _, unit in counts], pa.string()),
        "n_rows": pa.array(counts.values(), pa.int64()),
    })
    units = [states[spec.name][unit] for spec in specs for unit in (spec.stores or (spec.name,))]
    clean = CleanFeed(records, union([spark.createDataFrame([], REJECTS), rejects]), feed_status(spark, units, [counted]))
    state.note_use(spark, root, every)
    return clean, reconciled
