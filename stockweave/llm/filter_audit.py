"""What filters remove in every order of them: intervals of permutation ranks, summed up once."""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm.frames import read, stage

#: One letter for each filter; the last one looks at the whole table.
FILTERS = "ABCDE"
LEAST_WORDS = 200
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#$%&*|]"
COUNTED = ["n", "good", "toxic"]
RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def removal_intervals(size: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, first, end) for every set of filters that a document may fail.

    The permutations of the filters are numbered as they are sorted (their Lehmer code read as a
    number), so those that begin alike are neighbours. A document goes at the first filter of its
    mask: each beginning of other filters followed by one of the mask is an interval of
    permutations, from ``first`` up to before ``end``, in which its ``step`` is the same.
    """
    found = []

    def walk(mask: int, left: tuple, start: int) -> None:
        width = factorial(len(left) - 1)
        for place, letter in enumerate(left):
            first = start + place * width
            if mask >> letter & 1:
                found.append((mask, size - len(left) + 1, first, first + width))
            else:
                walk(mask, left[:place] + left[place + 1 :], first)

    for mask in range(1, 1 << size):
        walk(mask, tuple(range(size)), 0)
    return found


def audit_counts(counts: np.ndarray, filters: str = FILTERS) -> dict[str, np.ndarray]:
    """The measures of all orders and steps, from ``counts`` of documents by their mask.

    ``counts`` has a row for each mask and the columns n, good and toxic. Every interval adds its
    mask's counts at its first rank and takes them off at its end; running sums over the ranks then
    give what each order removes at each step. Arrays are indexed by rank and step, from zero.
    """
    size = len(filters)
    ranks = factorial(size)
    mask, step, first, end = np.array(removal_intervals(size)).T
    change = np.zeros((ranks + 1, size, len(COUNTED)), dtype=np.int64)
    np.add.at(change, (first, step - 1), counts[mask])
    np.add.at(change, (end, step - 1), -counts[mask])
    removed, good, toxic = np.moveaxis(change.cumsum(axis=0)[:-1], 2, 0)
    letters = np.array(list(permutations(range(size))))
    masks = np.arange(1 << size)
    failing = np.array([counts[masks >> f & 1 == 1, 0].sum() for f in range(size)])
    alone = counts[1 << np.arange(size), 0]
    shapley = np.zeros(size, dtype=np.int64)
    np.add.at(shapley, letters, removed)
    return {
        "kept": counts[:, 0].sum() - removed.cumsum(axis=1), "removed": removed, "redundant": failing[letters] - removed,
        "unique_fails": alone[letters], "good_lost": good, "toxic_lost": toxic, "shapley": shapley[letters],
    }


def interactions(flagged: DataFrame, filters: str = FILTERS) -> DataFrame:
    """The audit of ``flagged`` (part, mask, n, good, toxic): ``RESULT`` columns, a row for every part,
    order of ``filters`` and step.

    Bit i of ``mask`` says that a row's documents fail filter i. Rows are added up by part and mask
    first, so what comes together for a part is a row for each mask at most. A null part is a part
    of its own; no rows give no rows.
    """
    orders = ["".join(order) for order in permutations(filters)]
    size, ranks = len(filters), len(orders)

    def audit(rows: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros((1 << size, len(COUNTED)), dtype=np.int64)
        np.add.at(counts, rows["mask"].to_numpy(), rows[COUNTED].to_numpy(dtype=np.int64))
        measures = audit_counts(counts, filters)
        return pd.DataFrame({
            "part": rows["part"].iloc[0], "filter_order": np.repeat(orders, size),
            "step": np.tile(np.arange(1, size + 1), ranks),
            **{name: values.reshape(-1) for name, values in measures.items()},
        })

    summed = flagged.groupBy("part", "mask").agg(*[F.sum(name).alias(name) for name in COUNTED])
    return summed.groupBy("part").applyInPandas(audit, RESULT)


def text_mask(text: Column) -> Column:
    """The filters A to D that a text fails, as bits 0 to 3."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    fails = [
        F.size(words) < LEAST_WORDS,
        100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.length(text),
        text.rlike(SYMBOLS),
    ]
    return sum((F.when(fail, 1 << bit).otherwise(0) for bit, fail in enumerate(fails)), F.lit(0))


def flag_documents(documents: DataFrame) -> DataFrame:
    """(doc_id, part, mask, n): how many documents of an id and a part fail which of the five filters.

    Null texts count as empty, null sources as the part ''. Texts are compared by their SHA-256 over
    the whole table; rows that repeat an id and a text fail the last filter only if a smaller id
    has the text. A row without id has no smaller id and is none, so it never fails it.
    """
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), text_mask(text).alias("mask"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    rows = stage(rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n")), "masks")
    firsts = rows.filter("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first"))
    met = rows.join(firsts.withColumnRenamed("digest", "first_digest"), [
        F.col("digest") == F.col("first_digest"), F.col("doc_id") == F.col("first")
    ], "left")
    repeats = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return met.select("doc_id", "part", (F.col("mask") + F.when(repeats, 16).otherwise(0)).alias("mask"), "n")


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """What each of the five filters removes from ``documents`` in each of their 120 orders, by source.

    ``labels`` (doc_id, quality, toxic) says which documents count as good or toxic. An id is good
    if any label of it is, likewise toxic; ids without label or with null labels are neither, and
    documents without id have no label. Each row of ``documents`` counts, also those that repeat an
    id. Whole texts are read, of any length; an empty table gives an empty one; other columns are
    not read.
    """
    flagged = stage(flag_documents(documents), "flagged")
    label = labels.groupBy("doc_id").agg(*[
        F.max(F.coalesce(F.col(column) == 1, F.lit(False)).cast("long")).alias(name)
        for column, name in (("quality", "good"), ("toxic", "toxic"))
    ]).filter("good + toxic > 0")
    every = flagged.select("part", "mask", "n", F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic"))
    labelled = flagged.join(label, "doc_id").select(
        "part", "mask", F.lit(0).cast("long").alias("n"), *[(F.col("n") * F.col(name)).alias(name) for name in ("good", "toxic")]
    )
    return interactions(every.unionByName(labelled))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
