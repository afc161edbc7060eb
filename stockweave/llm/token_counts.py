"""Token counts by merging whole batches of pieces at once."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm.frames import read, text_batches
from stockweave.llm.pieces import splitter

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: Entries of a worker's memo of piece lengths; a full memo is emptied.
PIECES_KEPT = 1 << 20
NEVER = np.iinfo(np.int32).max


def byte_letters() -> list[str]:
    """The letters which stand for the 256 bytes in a byte-level vocabulary: printable ones for
    themselves, the others for the letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in set(plain))
    letters = {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}
    return [letters[b] for b in range(256)]


class BatchMerger:
    """Counts the tokens of many pieces by the merges of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parsed = json.load(file)
        vocabulary = parsed["model"]["vocab"]
        self.byte_ids = np.array([vocabulary[x] for x in byte_letters()], dtype=np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in parsed["model"]["merges"]]
        self.width = max(vocabulary.values()) + 1
        keys = np.array([vocabulary[a] * self.width + vocabulary[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocabulary[a + b] for a, b in merges], dtype=np.int64)
        specials = sorted((x["content"] for x in parsed["added_tokens"]), key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.known: dict[str, int] = {}

    def _rank(self, symbols: np.ndarray, same: np.ndarray) -> np.ndarray:
        """The rank of each symbol with its right neighbour, NEVER where they do not merge."""
        pairs = symbols[:-1] * self.width + symbols[1:]
        at = np.searchsorted(self.keys, pairs)
        at[at == len(self.keys)] = 0
        return np.where((self.keys[at] == pairs) & same, self.ranks[at], NEVER)

    def lengths(self, pieces: list[bytes]) -> np.ndarray:
        """How many tokens each piece has.

        All pieces lie in one flat array of symbols, beside the piece that each belongs to. In every
        round each piece merges all places of its lowest-ranked pair (of overlapping ones every
        other, from the left); a piece without a pair to merge is done and leaves the array.
        """
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        done = sizes.copy()
        symbols = self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        while len(symbols):
            rank = self._rank(symbols, owner[:-1] == owner[1:])
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            ends = np.append(starts[1:], len(symbols))
            best = np.minimum.reduceat(np.append(rank, NEVER), starts)
            done[owner[starts]] = ends - starts
            active = best < NEVER
            if not active.any():
                break
            merging = np.append(rank, NEVER) == np.repeat(np.where(active, best, -1), ends - starts)
            at = np.flatnonzero(merging)
            run = np.flatnonzero(np.concatenate(([True], np.diff(at) > 1)))
            offset = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
            # ends of pieces never merge, so a run of neighbours lies in one piece
            at = at[offset % 2 == 0]
            symbols[at] = self.made[rank[at]]
            stays = np.repeat(active, ends - starts)
            stays[at + 1] = False
            symbols, owner = symbols[stays], owner[stays]
        return done

    def counts(self, texts: list[str]) -> list[int]:
        """How many tokens each text has; strings of added tokens count as one, as by default."""
        split, known = splitter(), self.known
        rows, added = [], []
        for text in texts:
            parts = self.specials.split(text) if self.specials else [text]
            rows.append([piece for part in parts for piece in split(part)])
            added.append(len(parts) - 1)
        if len(known) >= PIECES_KEPT:
            known.clear()
        fresh = list({piece for row in rows for piece in row if piece not in known})
        known.update(zip(fresh, self.lengths([p.encode() for p in fresh]).tolist()))
        return [n + sum(map(known.__getitem__, row)) for n, row in zip(added, rows)]


@lru_cache(maxsize=2)
def merger(path: str) -> BatchMerger:
    """The merger of a vocabulary file, built once in each worker."""
    return BatchMerger(path)


def token_count_column(path: str | None = None, batch_chars: int = 1 << 21):
    """A column function: the number of tokens of a text; pieces of about ``batch_chars`` characters
    (one text at least) are merged at once."""
    path = path or public_tokenizers.path(VOCABULARY)

    @F.pandas_udf("long")
    def counted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = merger(path).counts
        for part in texts:
            found, held, size = [], [], 0
            for text in part:
                held.append(text or "")
                size += len(held[-1])
                if size >= batch_chars:
                    found += count(held)
                    held, size = [], 0
            yield pd.Series(found + count(held), dtype="int64")

    return counted


def count_tokens(documents: DataFrame, limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``documents``.

    A null text counts as empty: no bytes, no tokens. Every row stands for itself; other columns
    are not read.
    """
    counted = text_batches(documents).select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        token_count_column(path)("text").alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"))
