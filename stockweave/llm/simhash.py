"""Near duplicates by SimHash, found through the bit counts of fingerprint segments."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm.components import connected_components
from stockweave.llm.frames import keep_one_row, read, stage, text_batches

SHINGLE = 4
MOST_BITS = 4
SEED = 42
ODD_BITS = 0x5555555555555555
SEGMENTS = 32  # of two bits each
#: Pairs to compare for each row of the grid, beyond which groups are first linked to a centre.
PAIRS_PER_ROW = 32


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text as an unsigned number; a bit is set if over half the shingles set it."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space alone
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(words) - shingle, 0)
    spans = zip(starts[: last + 1].tolist(), ends[min(shingle, len(words)) - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=">u8")
    total = np.zeros(64, dtype=np.int64)
    for block in range(0, len(hashes), 1 << 16):
        part = hashes[block : block + (1 << 16)].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes)).tobytes(), "big")


def fingerprint_column(shingle: int = SHINGLE):
    """A column function: the fingerprint of a text as a signed long."""

    @F.pandas_udf("long")
    def fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            made = np.array([fingerprint(x, shingle) for x in part], dtype=np.uint64)
            yield pd.Series(made.view(np.int64))

    return fingerprints


def embed(fp: Column) -> Column:
    """The bit counts of all two-bit segments, each in unary, so that the Manhattan distance of two
    embeddings is the number of bits in which they differ."""
    high = F.shiftrightunsigned(fp, 1)
    any_bit = fp.bitwiseOR(high).bitwiseAND(F.lit(ODD_BITS))
    both_bits = F.shiftleft(fp.bitwiseAND(high).bitwiseAND(F.lit(ODD_BITS)), 1)
    return any_bit.bitwiseOR(both_bits)


def grid_masks(most_bits: int) -> list[int]:
    """Masks of the embedding, one for each pair of blocks of segments.

    With ``most_bits`` + 2 blocks, two embeddings within that distance agree in two blocks at least,
    so they share a cell of the grid that is laid over some pair of blocks.
    """
    blocks = np.array_split(np.arange(SEGMENTS), most_bits + 2)
    masks = [sum(3 << (2 * int(i)) for i in block) for block in blocks]
    return [_signed(a | b) for a, b in combinations(masks, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _differ(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def link(fingerprints: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """(node, component) for the distinct ``fingerprints`` (fp, n) that have a link.

    Cells of the grid give candidates; the Manhattan distance of the embeddings, a lower bound of
    the distance in bits, screens them; the fingerprints decide. Where a cell holds a large group of
    near copies, comparing all its pairs is needless: each fingerprint of a cell is first compared
    with the cell's most frequent one. What is then in one component with that centre needs
    comparing only with the cell's other rows. If that still leaves many pairs, the others get a
    centre of their own, and so on while that links anything. No pair that could join two
    components is left out.
    """
    cells = stage(
        fingerprints.select("fp", "n", embed(F.col("fp")).alias("e")).select(
            "fp", "n", "e", F.posexplode(F.array(*[F.col("e").bitwiseAND(F.lit(m)) for m in grid_masks(most_bits)]))
            .alias("band", "cell"),
        ), "cells",
    )
    shared = stage(cells.groupBy("band", "cell").agg(F.count("*").alias("size")).filter("size > 1"), "shared-cells")
    cells = stage(cells.join(shared, ["band", "cell"]).drop("size"), "grid")
    rows = cells.count()
    links, others, merged = None, cells, -1
    while True:
        centres = stage(
            others.groupBy("band", "cell").agg(F.max_by("fp", "n").alias("centre")), "centres"
        )
        near = others.join(centres, ["band", "cell"]).filter((F.col("fp") != F.col("centre")) & (_differ("fp", "centre") <= most_bits))
        found = stage(near.select(F.col("fp").alias("a"), F.col("centre").alias("b")).distinct(), "links")
        links = found if links is None else stage(links.unionByName(found), "links")
        labels = stage(connected_components(links), "labels")
        labelled = stage(
            cells.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
            .withColumn("label", F.coalesce("component", "fp")).drop("component"), "labelled",
        )
        # the main label of a cell is that of most of its rows
        shares = labelled.groupBy("band", "cell", "label").agg(F.count("*").alias("share"))
        mains = stage(shares.groupBy("band", "cell").agg(
            F.max_by("label", "share").alias("main"), F.sum("share").alias("size"), F.count("*").alias("labels")
        ).filter("labels > 1").drop("labels"), "mixed-cells")
        mixed = labelled.join(mains, ["band", "cell"])
        others = stage(mixed.filter("label <> main"), "others")
        pairs = others.agg(F.sum("size")).first()[0] or 0
        before, merged = merged, labels.filter("node <> component").count()
        if pairs <= PAIRS_PER_ROW * rows or merged == before:
            break
    right = stage(mixed.select(
        "band", "cell", F.col("fp").alias("fp2"), F.col("e").alias("e2"), F.col("label").alias("label2"),
        (F.col("label") == F.col("main")).alias("is_main"),
    ), "mixed")
    pairs = others.join(right, ["band", "cell"]).filter(
        (F.col("label") != F.col("label2")) & (F.col("is_main") | (F.col("fp") < F.col("fp2")))
        & (_differ("e", "e2") <= most_bits) & (_differ("fp", "fp2") <= most_bits)
    )
    rest = pairs.select(F.col("fp").alias("a"), F.col("fp2").alias("b")).distinct()
    joined = labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(rest)
    return connected_components(joined)


def _labelled(documents: DataFrame, shingle: int, most_bits: int) -> DataFrame:
    """doc_id, fp, label (one of the fingerprints of the group) and component_id of each document."""
    prints = stage(text_batches(documents).select("doc_id", fingerprint_column(shingle)("text").alias("fp")), "fingerprints")
    distinct = stage(
        prints.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")), "distinct"
    )
    labels = link(distinct.select("fp", "n"), most_bits)
    groups = stage(
        distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "first_id", F.coalesce("component", "fp").alias("label")), "groups",
    )
    names = stage(groups.groupBy("label").agg(F.min("first_id").alias("component_id")), "names")
    named = stage(groups.join(names, "label").select("fp", "label", "component_id"), "named")
    return prints.join(named, "fp").select("doc_id", "fp", "label", "component_id")


def near_dedup(documents: DataFrame, shingle: int = SHINGLE, most_bits: int = MOST_BITS) -> DataFrame:
    """doc_id, fp (signed) and component_id, one row for each document.

    Documents whose fingerprints differ in at most ``most_bits`` bits are linked; component_id is the
    smallest doc_id that links reach. Null, empty and blank texts have the fingerprint 0, which
    links like any other. A null doc_id takes part but names no component unless all are null; rows
    with one doc_id are separate documents. Other columns are not read.
    """
    return _labelled(documents, shingle, most_bits).drop("label")


def kept_documents(documents: DataFrame, shingle: int = SHINGLE, most_bits: int = MOST_BITS) -> DataFrame:
    """One row of ``documents``, whole, for each group of linked documents: that of the smallest doc_id,
    then fingerprint; one without a doc_id only if none has one. Groups that share a doc_id, or have
    none, each keep their own."""
    found = _labelled(documents, shingle, most_bits)
    same = stage(found.groupBy("label", "doc_id", "fp").agg(F.count("*").alias("n")), "near-duplicates")
    head = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "n")).alias("head")
    wanted = same.groupBy("label").agg(head).select("head.doc_id", "head.fp", "head.n")
    rows = documents.select(F.struct("*").alias("row"), "doc_id", fingerprint_column(shingle)("text").alias("fp"))
    return keep_one_row(rows, ["doc_id", "fp"], stage(wanted, "kept")).select("row.*")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint in hexadecimal and its component."""
    found = near_dedup(read(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")
