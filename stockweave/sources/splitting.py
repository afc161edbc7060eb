"""Records of one large document, found by many tasks at once.

A text file can be cut anywhere at a character, but whether that character ends a record depends on all
that comes before: a line break may stand in a quoted cell, a brace in a string or in an inner object.
So each piece of the text says how it would change the state it starts in, for every such state. These
changes are put together by a prefix scan, first within a block of the file, then over the blocks, one
short row each. After that every piece knows its state, and pieces that belong to one record are
joined; nearly all records are one piece. Nothing but a record ever has to be in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockweave.functions.ordinal import row_in_task, text_position
from stockweave.sources.staging import stage

BLOCK = ["path", "block"]
#: Bytes of text that are worth a task of their own, and that pieces of a record are put together by.
TASK_BYTES = STRETCH = 1 << 24
#: Cells of a line, each up to its comma; a quote counts at the start of a cell alone.
CLOSED_CELLS = r'^(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+)?+(?:,|$))*+'
#: The rest of a JSON string with its closing quote, and a whole string.
STRING_REST = r'^(?:[^"\\]++|\\.)*+"'
STRING = r'"(?:[^"\\]++|\\.)*+"'
#: What stands before the first brace outside of strings.
BEFORE_BRACE = r'^(?:[^"{]++|"(?:[^"\\]++|\\.)*+")*+'
#: A list of plain values, and the start of a list under a key which is still open.
PLAIN_LIST = r'\[(?:[^\[\]"]++|"(?:[^"\\]++|\\.)*+")*+\]'
OPEN_LIST = r'"((?:[^"\\]++|\\.)*+)"\s*+:\s*+\[((?:[^\[\]"]++|"(?:[^"\\]++|\\.)*+")*+)$'
#: What may stand between the objects of a list, and before the first one.
BETWEEN, BEFORE_FIRST = r"^\s*,\s*(?:null\s*,\s*)*$", r"^\s*(?:null\s*,\s*)*$"
AFTER_LAST = r"^\s*(?:,\s*null\s*)*(?:\]|$)"


class MalformedDocument(Exception):
    """A document that is not what it should be."""


def text_pieces(spark: SparkSession, paths: Sequence[str], separator: str) -> DataFrame:
    """The files cut at a character: path, block, position, _file and the piece without it.

    The files are split like any other, so a piece is read by the task whose block it begins in.
    """
    lines = spark.read.option("lineSep", separator).option("recursiveFileLookup", True).text(list(paths))
    read = lines.select(F.col("_metadata").alias("_file"), row_in_task().alias("_row"), "value")
    file = F.col("_file")
    return read.select(
        file["file_path"].alias("path"), file["file_block_start"].alias("block"),
        text_position(file, F.col("_row")).alias("position"), "_file", "value",
    )


def tasks_for(pieces: DataFrame) -> int:
    """How many tasks pieces are dealt to: as many as the files are read by, which grows with them, or
    fewer if these are small. Else a task's sort would grow with the input, as
    ``spark.sql.shuffle.partitions`` does not."""
    spark, splits = pieces.sparkSession, pieces.rdd.getNumPartitions()
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return max(1, min(splits, -(-splits * size // TASK_BYTES)))


def _before(*partition: str, order: str):
    return Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _state(start: Column, fixed: Column, flips: Column) -> Column:
    """A state of 0 or 1 from that at the start, the last change to a fixed state (state, flips up to
    it), and the number of flips."""
    return F.when(fixed.isNotNull(), (fixed["state"] + flips - fixed["flips"]) % 2).otherwise((start + flips) % 2)


def with_states(pieces: DataFrame, from_zero: Column, from_one: Column) -> DataFrame:
    """Adds ``state``, 0 or 1, in which each piece starts; a file starts in 0.

    ``from_zero`` and ``from_one`` are the states a piece ends in, by the one it starts in. A piece
    that ends alike from both fixes the state; others keep or flip it. The state of a piece is
    thus what the last fixed one left, flipped as often as since then.
    """
    marked = pieces.withColumns({"_zero": from_zero, "_one": from_one})
    marked = marked.withColumn("_flip", F.when((F.col("_zero") == 1) & (F.col("_one") == 0), 1).otherwise(0))
    flips = F.sum("_flip").over(Window.partitionBy(*BLOCK).orderBy("position").rowsBetween(Window.unboundedPreceding, 0))
    fix = F.when(F.col("_zero") == F.col("_one"), F.struct(F.col("_zero").alias("state"), F.col("_flips").alias("flips")))
    placed = marked.withColumn("_flips", flips).withColumn("_fix", fix)

    # one row for each block: what it does as a whole
    small = placed.drop("value").groupBy(*BLOCK).agg(
        F.max("_flips").alias("_all"), F.max_by("_fix", F.when(F.col("_fix").isNotNull(), F.col("position"))).alias("_last"),
    )
    earlier = _before("path", order="block")
    block_flips = F.coalesce(F.sum("_all").over(earlier), F.lit(0))
    summed = small.withColumn("_flips", block_flips)
    last = F.when(F.col("_last").isNotNull(), F.struct(
        F.col("_last.state").alias("state"), (F.col("_flips") + F.col("_last.flips")).alias("flips")))
    fixed = F.last(last, ignorenulls=True).over(earlier)
    starts = summed.withColumn("_fixed", fixed).select(*BLOCK, _state(F.lit(0), F.col("_fixed"), F.col("_flips")).alias("_start"))

    inside = _before(*BLOCK, order="position")
    known = placed.withColumns({
        "_fixed": F.last("_fix", ignorenulls=True).over(inside), "_before": F.col("_flips") - F.col("_flip"),
    })
    state = _state(F.col("_start"), F.col("_fixed"), F.col("_before"))
    return known.join(starts, BLOCK).select(*pieces.columns, state.cast("int").alias("state"))


def with_sums(pieces: DataFrame, value: Column, name: str) -> DataFrame:
    """Adds the sum of ``value`` over all earlier pieces of the file."""
    marked = pieces.withColumn("_value", value)
    blocks = marked.groupBy(*BLOCK).agg(F.sum("_value").alias("_all"))
    starts = blocks.select(*BLOCK, F.coalesce(F.sum("_all").over(_before("path", order="block")), F.lit(0)).alias("_start"))
    inside = F.coalesce(F.sum("_value").over(_before(*BLOCK, order="position")), F.lit(0))
    return marked.withColumn("_inside", inside).join(starts, BLOCK).select(
        *pieces.columns, (F.col("_start") + F.col("_inside")).alias(name)
    )


def with_last(pieces: DataFrame, value: Column, name: str) -> DataFrame:
    """Adds the last ``value`` that is not NULL up to each piece of the file, its own included."""
    up_to_here = Window.partitionBy(*BLOCK).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    marked = pieces.withColumn("_value", value)
    blocks = marked.groupBy(*BLOCK).agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("position"))).alias("_all"))
    starts = blocks.select(*BLOCK, F.last("_all", ignorenulls=True).over(_before("path", order="block")).alias("_start"))
    inside = F.last("_value", ignorenulls=True).over(up_to_here)
    return marked.withColumn("_inside", inside).join(starts, BLOCK).select(
        *pieces.columns, F.coalesce("_inside", "_start").alias(name)
    )


def joined(pieces: DataFrame, separator: str, tasks: int) -> DataFrame:
    """Pieces with the same ``begin``, the position of the first one, as one text: path, begin, value. A
    task is dealt whole stretches of a file."""
    in_order = F.sort_array(F.collect_list(F.struct("position", "value")))
    dealt = pieces.withColumn("_stretch", F.floor(F.col("begin") / STRETCH)).repartition(tasks, "path", "_stretch")
    return dealt.groupBy("path", "_stretch", "begin").agg(
        F.array_join(F.transform(in_order, lambda piece: piece["value"]), separator).alias("value"),
    ).drop("_stretch")


def _open_cell(line: Column) -> Column:
    """1 if a quoted cell is open at the end of a line that starts at the start of a cell."""
    return F.when(F.regexp_replace(line, CLOSED_CELLS, "") == "", 0).otherwise(1)


def csv_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The records of CSV files whose cells may hold line breaks: path, begin (where the record's first
    line begins), value. Empty records are left out, as in any CSV file."""
    lines = text_pieces(spark, paths, "\n").drop("_file").withColumn("value", F.regexp_replace("value", "\r$", ""))
    tasks = tasks_for(lines)
    plain = ~F.contains("value", F.lit('"'))  # without quotes, the state stays as it is
    marked = with_states(
        lines.repartition(tasks, *BLOCK), F.when(plain, 0).otherwise(_open_cell(F.col("value"))),
        F.when(plain, 1).otherwise(_open_cell(F.concat(F.lit('"'), "value"))),
    )
    stated = stage(marked, "lines").repartition(tasks, *BLOCK)
    begun = with_last(stated, F.when(F.col("state") == 0, F.col("position")), "begin")
    return joined(begun, "\n", tasks).where("value <> ''")


def _from_outside(piece: Column, state: Column) -> Column:
    """A piece from where it is outside of the string that it starts in; '' if it is nowhere."""
    rest = F.when(piece.rlike(STRING_REST), F.regexp_replace(piece, STRING_REST, "")).otherwise("")
    return F.when(state == 1, rest).otherwise(piece)


def _without_strings(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, STRING, ""), r'"[\s\S]*$', "")


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _document_ends(pieces: DataFrame) -> DataFrame:
    """One row for each document: its last piece, and whether a separator follows it (by the number of
    bytes; a byte order mark is none of the text)."""
    size = F.max("_file.file_size") - F.sum(F.octet_length("value") + 1)
    ends = stage(pieces.groupBy("path").agg(
        F.max("position").alias("_last"), F.max_by("value", "position").alias("_tail"), size.isin(-1, 2).alias("_open"),
    ), "document-ends")
    cut = ends.where("_open and trim(_tail) rlike '[^\\\\s]'").first()
    if cut is not None:
        raise MalformedDocument(f"MALFORMED_RECORD: {cut.path} ends within its document")
    return ends.drop("_tail")


def json_elements(spark: SparkSession, paths: Sequence[str], key: str) -> DataFrame:
    """The objects in the list that stands under ``key`` in the root object of JSON documents, one
    document a file: path, begin, value (the object's text).

    Pieces end at closing braces. Where a piece starts, in a string or not and how deep, follows from
    all quotes and brackets before it; which list an object stands in, from the last key that
    opened one. A document that does not close all it opens fails, and so does one whose list holds
    something else than objects and nulls; nulls are left out.
    """
    pieces = text_pieces(spark, paths, "}")
    tasks = tasks_for(pieces)
    ends = _document_ends(pieces)
    pieces = pieces.drop("_file").repartition(tasks, *BLOCK)
    quotes = F.regexp_count(F.regexp_replace("value", r"\\.", ""), F.lit('"')) % 2
    stated = with_states(pieces, quotes, 1 - quotes).join(ends, "path")
    closed = ((F.col("state") + quotes) % 2 == 0) & ~(F.col("_open") & (F.col("position") == F.col("_last")))
    body = _from_outside(F.col("value"), F.col("state"))
    bare = _without_strings(body)
    marked = stage(stated.withColumns({
        "change": _count(bare, "[{") - _count(bare, "]") - closed.cast("int"),
        "in_string": (F.col("state") + quotes) % 2,
    }).drop("_last", "_open"), "pieces")
    _require_closed(marked)

    deep = with_sums(marked.repartition(tasks, *BLOCK), F.col("change"), "depth")
    root = F.regexp_replace(body, r"^\s*\{", "")
    bad_root = F.raise_error(F.concat(F.lit("MALFORMED_RECORD: no object in "), "path")).cast("string")
    inner = F.when(F.col("depth") > 0, body).when(body.rlike(r"^\s*\{"), root).when(body.rlike(r"\S"), bad_root).otherwise("")
    opened = deep.withColumn("body", F.when(F.col("depth") <= 2, inner).otherwise(""))
    opened = opened.withColumn("head", F.regexp_extract("body", BEFORE_BRACE, 0))
    flat = F.col("head")
    for _ in range(3):  # lists in lists of plain values
        flat = F.regexp_replace(flat, PLAIN_LIST, "0")
    begins = F.length("head") < F.length("body")
    renewed = begins & ((F.col("depth") <= 1) | F.contains(_without_strings(F.col("flat")), F.lit("]")))
    opened = opened.withColumn("flat", flat).withColumn("_new", renewed)
    holder = F.when(F.col("_new"), F.concat(F.lit("list "), F.regexp_extract("flat", OPEN_LIST, 1)))
    holder = F.when(F.col("_new") & ~F.col("flat").rlike(OPEN_LIST), "object").otherwise(holder)
    held = with_last(stage(opened, "openings").repartition(tasks, *BLOCK), holder, "holder")

    begins = F.length("head") < F.length("body")
    wanted = begins & (F.col("holder") == f"list {key}")
    lead = F.when(F.col("_new"), F.regexp_extract("flat", OPEN_LIST, 2)).otherwise(F.col("flat"))
    fits = F.when(F.col("_new"), lead.rlike(BEFORE_FIRST)).otherwise(lead.rlike(BETWEEN))
    # the last object of the list, and what follows it up to the end of the list
    ending = ~begins & (F.col("depth") == 2) & (F.col("holder") == f"list {key}") & ~F.col("flat").rlike(AFTER_LAST)
    wanted, fits = wanted | ending, fits & ~ending
    odd = F.raise_error(F.concat(F.lit(f"MALFORMED_RECORD: not an object in {key} of "), "path")).cast("string")
    text = (
        F.when(wanted & ~fits, odd).when(begins, F.substr("body", F.length("head") + 1)).otherwise(F.col("value"))
    )
    start = F.when(begins | ending, F.struct("position", wanted.alias("wanted")))
    parts = held.withColumn("text", text).where((F.col("depth") > 2) | begins | ending)
    begun = with_last(parts, start, "start").where("start.wanted").select(
        "path", "block", "position", F.col("text").alias("value"), F.col("start.position").alias("begin")
    )
    return joined(begun, "}", tasks).withColumn("value", F.concat("value", F.lit("}")))


def _require_closed(pieces: DataFrame) -> None:
    """Every document has to end outside of strings, with all brackets closed."""
    open_ = pieces.groupBy("path").agg(
        F.sum("change").alias("depth"), F.max_by("in_string", "position").alias("in_string")
    ).where("depth <> 0 or in_string <> 0").first()
    if open_ is not None:
        raise MalformedDocument(f"MALFORMED_RECORD: {open_.path} does not close what it opens")
