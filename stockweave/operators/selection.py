"""Rows by their place in an order, without sorting the table.

The page that starts at row one million is found as an order statistic is: a sample of keys cuts the
table into ranges, one aggregation counts the rows of each, and only the ranges that the page
touches are looked at again, until they hold little more than the page. Each round reads the keys
of the rows in question twice and moves one number for each range. Nothing is written, and what
is sorted in the end is a few pages' worth of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that cut a range in a round.
CUTS = 96
SEED = 5
#: A range is sorted once it holds no more than so many times the rows wanted.
SORTED_PAGES = 8
#: Up to so many rows from the start of the table a top-k is as good.
TOP_ROWS = 500

#: Columns of a total order, and whether each is descending.
Order = Sequence[tuple[str, bool]]


def sort_columns(order: Order) -> list[Column]:
    return [F.col(name).desc() if down else F.col(name).asc() for name, down in order]


def total_order(rows: DataFrame, order: Order) -> list[tuple[str, bool]]:
    """``order``, and then all other columns: rows that still tie are the same in every column."""
    named = [name for name, _ in order]
    return [*order, *[(name, False) for name in rows.columns if name not in named]]


def before(order: Order, key: Sequence) -> Column:
    """Whether a row comes before a key. NULL is the smallest value, as in a sort."""
    found, level = F.lit(False), F.lit(True)
    for (name, down), value in zip(order, key, strict=True):
        column = F.col(name)
        if value is None:
            less = column.isNotNull() if down else F.lit(False)
        elif down:
            less = F.coalesce(column > F.lit(value), F.lit(False))
        else:
            less = column.isNull() | (column < F.lit(value))
        found = found | (level & less)
        level = level & column.eqNullSafe(F.lit(value))
    return found


def equal(order: Order, key: Sequence) -> Column:
    pairs = [F.col(name).eqNullSafe(F.lit(value)) for (name, _), value in zip(order, key, strict=True)]
    return reduce(lambda left, right: left & right, pairs)


@dataclass(frozen=True)
class Range:
    """The rows between two keys; None stands for the end of the table."""

    low: tuple | None = None
    high: tuple | None = None
    with_low: bool = False
    with_high: bool = False

    def where(self, rows: DataFrame, order: Order) -> DataFrame:
        if self.low is not None:
            below = before(order, self.low)
            rows = rows.where(~below if self.with_low else ~(below | equal(order, self.low)))
        if self.high is not None:
            below = before(order, self.high)
            rows = rows.where(below | equal(order, self.high) if self.with_high else below)
        return rows

    def stretches(self, keys: Sequence[tuple], first: int, last: int) -> Range:
        """The part of this range from one stretch that ``keys`` cut it into to another."""
        with_low = bool(first % 2)
        low, high = first // 2 - (not with_low), last // 2
        return Range(
            keys[low] if low >= 0 else self.low, keys[high] if high < len(keys) else self.high,
            with_low if low >= 0 else self.with_low, bool(last % 2) if high < len(keys) else self.with_high,
        )


def sample_keys(rows: DataFrame, order: Order, cuts: int = CUTS) -> list[tuple]:
    """The keys of ``cuts`` random rows, in order and without repeats: a top-k by random numbers."""
    keys = rows.select(*[name for name, _ in order])
    sampled = keys.orderBy(F.rand(SEED)).limit(cuts).distinct().orderBy(*sort_columns(order))
    return [tuple(row) for row in sampled.collect()]


def _place(order: Order, keys: Sequence[tuple]) -> Column:
    """Number of the stretch that a row lies in: 2 i before the i-th key, 2 i + 1 at it. The keys
    are a search tree, so a row meets the logarithm of their number."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(2 * low)
        middle = (low + high) // 2
        return (
            F.when(before(order, keys[middle]), search(low, middle))
            .when(equal(order, keys[middle]), 2 * middle + 1)
            .otherwise(search(middle + 1, high))
        )

    return search(0, len(keys))


def count_stretches(rows: DataFrame, order: Order, keys: Sequence[tuple]) -> dict[int, int]:
    """How many rows lie before, at and between the keys; a hash aggregation of a few numbers."""
    counted = rows.groupBy(_place(order, keys).alias("place")).agg(F.count(F.lit(1)).alias("n"))
    return {row.place: row.n for row in counted.collect()}


def _top(rows: DataFrame, order: Order, start: int, count: int) -> DataFrame:
    return rows.orderBy(*sort_columns(order)).offset(start).limit(count)


def _parts(rows: DataFrame, order: Order, span: Range, start: int, count: int) -> Iterator[DataFrame]:
    """The ``count`` rows from ``start`` on (from 0) among the rows of a range, in parts."""
    inside = span.where(rows, order)
    keys = sample_keys(inside, order)
    sizes = count_stretches(inside, order, keys) if keys else {}
    end, at = start + count, 0
    touched = []
    for place in sorted(sizes):
        first, last = max(start, at), min(end, at + sizes[place])
        if first < last:
            touched.append((place, first - at, last - first))
        at += sizes[place]
    if not touched:
        return
    if sum(sizes[place] for place, _, _ in touched) <= SORTED_PAGES * count:
        part = span.stretches(keys, touched[0][0], touched[-1][0]).where(rows, order)
        yield _top(part, order, touched[0][1], sum(taken for _, _, taken in touched))
        return
    for place, skipped, taken in touched:
        part = span.stretches(keys, place, place)
        if place % 2:  # rows that are the same in every column
            yield part.where(rows, order).limit(taken)
        elif sizes[place] <= SORTED_PAGES * count:
            yield _top(part.where(rows, order), order, skipped, taken)
        else:
            yield from _parts(rows, order, part, skipped, taken)


def rows_between(rows: DataFrame, start: int, count: int, order: Order) -> DataFrame:
    """The ``count`` rows from ``start`` on (from 0), sorted.

    Rows that tie in ``order`` are put in the order of their other columns, so that pages never
    overlap. The columns have to be ones that Spark can compare, and the same whenever the rows are
    computed: of sums of fractions, keep the digits that count. A place beyond the last row gives
    an empty table.
    """
    full = total_order(rows, order)
    if start + count <= TOP_ROWS:
        return _top(rows, full, start, count)
    found = list(_parts(rows, full, Range(), start, count))
    if len(found) == 1:
        return found[0]
    if not found:
        return rows.limit(0)
    return reduce(DataFrame.unionAll, found).orderBy(*sort_columns(full)).limit(count)
