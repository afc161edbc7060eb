"""Record order for landed files.

Which record wins depends on the order in which records were read, so every record carries an
ordinal: phase, then file, then position in the file, packed in one bigint. Beside three bits for
the phase there are 60, of which the file number takes as many as the number of files needs, so
what is limited is just the whole: files times the size of the largest stays below an exabyte. The
position needs no shuffle and no second scan:

* Parquet knows the row index.
* Text formats know where the block starts in the file. A block cannot hold more rows than bytes,
  and Spark packs a task with at most one block's worth of bytes, so block start plus the row's
  number in its task grows with the file order and never repeats within a file, whatever the
  split size. A retried task computes the same numbers. A session which packs several blocks of
  a file into one task (``spark.sql.files.maxPartitionNum``) could break that; it fails the query
  rather than misnumber the rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PHASE_SHIFT = 60
_ROW_IN_TASK = (1 << 33) - 1


def row_in_task() -> Column:
    """Running number of the row in its task.

    Use it right above the scan, or above the explode of its lists: an element takes at least as
    many bytes as a row.
    """
    return F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_IN_TASK))


def text_position(file: Column, row: Column) -> Column:
    """Position in a CSV or JSON file, given the scan's ``_metadata`` and the row in the task."""
    start, length = file["file_block_start"], file["file_block_length"]
    last_block = start + length >= file["file_size"]
    return F.when(last_block | (row < length), start + row).otherwise(
        F.raise_error(F.lit("several file blocks in one task: rows cannot be numbered"))
        .cast("bigint")
    )


def parquet_position(file: Column, row: Column) -> Column:
    """Position in a Parquet file; the row in the task is not needed."""
    return file["row_index"]


def position_bits(files: int) -> int:
    """Bits that are left for the position beside the number of one of ``files`` files."""
    return PHASE_SHIFT - max(files - 1, 0).bit_length()


def ordinal(phase: int, file_no: Column, position: Column, files: int) -> Column:
    bits = position_bits(files)
    checked = F.when(position < F.lit(1 << bits), position).otherwise(
        F.raise_error(F.lit("files and positions do not fit the ordinal")).cast("bigint")
    )
    return (
        F.lit(phase << PHASE_SHIFT) + F.shiftleft(file_no.cast("bigint"), bits) + checked
    )
