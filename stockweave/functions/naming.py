"""Snapshot names, times and labels.

All texts are put together from the parts of a time without zone and taken apart into them, so the
session's time zone and its clock changes have no part in it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockweave.fixed_values import INDEX_NAME, LABEL_PREFIX, SNAPSHOT_SUFFIX, TIME_ZONE

NAME_PATTERN = "^[0-9]{6}_[0-9]{6}$"


def _digits(part: Column, width: int = 2) -> Column:
    return F.lpad(part.cast("string"), width, "0")


def _clock(ts: Column, separator: str) -> Column:
    parts = [_digits(part(ts)) for part in (F.hour, F.minute, F.second)]
    return F.concat_ws(separator, *parts)


def snapshot_name(ts: Column) -> Column:
    """``ddMMyy_HHmmss``."""
    date = [_digits(F.dayofmonth(ts)), _digits(F.month(ts)), _digits(F.year(ts) % 100)]
    return F.concat(*date, F.lit("_"), _clock(ts, ""))


def file_name(ts: Column) -> Column:
    return F.concat(snapshot_name(ts), F.lit(SNAPSHOT_SUFFIX))


def snapshot_ts(name: Column) -> Column:
    """Time in a snapshot name, NULL for a malformed one; two-digit years are 20xx."""
    stem = F.substring_index(name, ".", 1)

    def part(place: int) -> Column:
        return F.substring(stem, place, 2).try_cast("int")

    ts = F.try_make_timestamp_ntz(
        part(5) + 2000, part(3), part(1), part(8), part(10), part(12)
    )
    return F.when(stem.rlike(NAME_PATTERN), ts)


def is_snapshot_file(name: Column) -> Column:
    return name.endswith(SNAPSHOT_SUFFIX) & (name != INDEX_NAME)


def time_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``."""
    date = F.concat_ws("-", _digits(F.year(ts), 4), _digits(F.month(ts)), _digits(F.dayofmonth(ts)))
    return F.concat_ws(" ", date, _clock(ts, ":"))


def snapshot_label(ts: Column) -> Column:
    """The prefix, ``dd/MM/yyyy`` and the time."""
    date = F.concat_ws("/", _digits(F.dayofmonth(ts)), _digits(F.month(ts)), _digits(F.year(ts), 4))
    return F.concat(F.lit(LABEL_PREFIX), date, F.lit(" "), _clock(ts, ":"))


def local_time(utc: Column) -> Column:
    """Shop clock for a UTC wall clock time."""
    return F.convert_timezone(F.lit("UTC"), F.lit(TIME_ZONE), utc.cast("timestamp_ntz"))


def last_updated_text(utc: Column) -> Column:
    return time_text(local_time(utc))
