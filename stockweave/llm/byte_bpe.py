"""Byte-level BPE in linear time: longest matches, checked pair by pair, with backtracking."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm.frames import read, text_batches
from stockweave.llm.pieces import splitter

RANKS = "byte_bpe_50k.tiktoken"
#: Entries of the memos of a worker; a full memo is emptied.
PIECES_KEPT, PAIRS_KEPT = 1 << 19, 1 << 19


@lru_cache(maxsize=2)
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def tokens_of(path: str) -> list[bytes]:
    """The bytes of each id; all that decoding needs."""
    ranks = ranks_of(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def decode(ids: bytes, tokens: list[bytes]) -> bytes:
    """The text of little-endian unsigned 32-bit ids."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def _merged(piece: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """BPE by its definition, with the ranks under ``below``; for short pieces."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, at = min((ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
        if best >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class ByteBpe:
    """Encoder of one rank file.

    A sequence of tokens is what the merges give if and only if every two neighbours are: taken
    apart, no step of the merges would have joined them another way. So the encoder takes the
    longest token at each place, the next shorter one if it does not go with its left neighbour,
    and steps back if none does; places from which nothing leads on are marked and never tried
    twice, which makes it linear in the length of the piece.
    """

    def __init__(self, path: str):
        self.ranks, self.tokens = ranks_of(path), tokens_of(path)
        self.halves: dict[int, tuple[int, int]] = {}
        self.joins: dict[tuple[int, int], int] = {}
        for token, rank in self.ranks.items():
            parts = [self.ranks[p] for p in _merged(token, self.ranks, rank)]
            if len(parts) == 2:
                self.halves[rank] = (parts[0], parts[1])
                self.joins[parts[0], parts[1]] = rank
            elif len(parts) == 1:
                self.halves[rank] = (rank, rank)
        # what the merges never make is found as a whole piece only
        self.automaton = ahocorasick.Automaton()
        self.shorter: dict[int, int] = {}
        for rank in self.halves:
            token = self.tokens[rank]
            self.automaton.add_word(token[::-1].decode("latin-1"), (rank, len(token)))
            prefixes = (self.ranks.get(token[:n]) for n in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((p for p in prefixes if p in self.halves), -1)
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.pieces: dict[str, bytes] = {}

    def _fits(self, left: int, right: int) -> bool:
        pair = left << 32 | right
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            known = self.pairs[pair] = self._stays_apart(left, right)
        return known

    def _stays_apart(self, left: int, right: int) -> bool:
        """Whether the merges leave a border between the two: undo the younger one's merge, again and
        again, and see whether the parts at the border would have been joined before."""
        limit = len(self.tokens)
        while True:
            if self.joins.get((left, right), limit) < limit:
                return False
            left_part, right_part = self.halves[left][1], self.halves[right][0]
            if left_part == left and right_part == right:
                return True
            if right_part == right or (left > right and left_part != left):
                limit, left = left, left_part
            else:
                limit, right = right + 1, right_part

    def _longest(self, piece: bytes) -> list[int]:
        """The longest token that starts at each place: that which ends there, read backwards."""
        found = [-1] * len(piece)
        last = len(piece) - 1
        for end, (rank, _) in self.automaton.iter(piece[::-1].decode("latin-1")):
            if found[last - end] < 0:  # of one end the longest comes first
                found[last - end] = rank
        return found

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        longest, size = self._longest(piece), len(piece)
        blocked = bytearray(size + 1)
        ids: list[int] = []
        at, token = 0, longest[0]
        while True:
            end = at + len(self.tokens[token])
            if not blocked[end] and (not ids or self._fits(ids[-1], token)):
                ids.append(token)
                if end == size:
                    return ids
                at, token = end, longest[end]
                continue
            token = self.shorter[token]
            while token < 0:  # nothing leads on from here
                blocked[at] = 1
                token = ids.pop()
                at -= len(self.tokens[token])
                token = self.shorter[token]

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        known, made = self.pieces, []
        for piece in splitter()(text):
            ids = known.get(piece)
            if ids is None:
                if len(known) >= PIECES_KEPT:
                    known.clear()
                ids = known[piece] = np.array(self.merge(piece.encode()), dtype="<u4").tobytes()
            made.append(ids)
        return b"".join(made)


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteBpe:
    """The encoder of a rank file, built once in each worker."""
    return ByteBpe(path)


def encode_column(path: str | None = None):
    """A column function: the ids of a text as little-endian unsigned 32-bit integers."""
    path = path or public_tokenizers.path(RANKS)

    @F.pandas_udf("binary")
    def encoded(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(path).encode
        for part in texts:
            yield pd.Series([encode(x or "") for x in part], dtype=object)

    return encoded


def decode_column(path: str | None = None):
    """A column function: the bytes that ids stand for."""
    path = path or public_tokenizers.path(RANKS)

    @F.pandas_udf("binary")
    def decoded(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = tokens_of(path)
        for part in ids:
            yield pd.Series([decode(x or b"", tokens) for x in part], dtype=object)

    return decoded


def round_trip_column(path: str | None = None):
    """A column function: ``token_ids`` of a text and the bytes ``decoded`` from them, in one pass."""
    path = path or public_tokenizers.path(RANKS)

    @F.pandas_udf("token_ids binary, decoded binary")
    def turned(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encode, tokens = encoder(path).encode, tokens_of(path)
        for part in texts:
            ids = [encode(x or "") for x in part]
            yield pd.DataFrame({"token_ids": ids, "decoded": [decode(x, tokens) for x in ids]}, dtype=object)

    return turned


def tokenize(documents: DataFrame, path: str | None = None) -> DataFrame:
    """All columns of ``documents``, and n_tokens and token_ids of the whole text.

    A null text counts as empty and has no ids; columns of the same names are replaced; every row
    stands for itself. Strings that look like special tokens are ordinary text.
    """
    ids = encode_column(path)("text")
    return text_batches(documents).withColumn("token_ids", ids).withColumn(
        "n_tokens", F.coalesce((F.octet_length("token_ids") / 4).cast("long"), F.lit(0))
    )


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes every text, decodes the ids, and returns digests of both."""
    turned = text_batches(read(spark, sf_dir, "documents")).select("doc_id", round_trip_column()("text").alias("turned"))
    return turned.select(
        "doc_id", F.coalesce((F.octet_length("turned.token_ids") / 4).cast("long"), F.lit(0)).alias("n_tokens"),
        F.sha2("turned.token_ids", 256).alias("ids_sha256"), F.sha2("turned.decoded", 256).alias("decoded_sha256"),
    )
