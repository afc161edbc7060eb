"""Aligning the tokens of two tokenizers, and counting which ids meet over a corpus."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm.frames import read, stage
from stockweave.llm.token_counts import byte_letters

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters whose tokens are aligned at once, and which make a block; a longer text is alone.
BLOCK_CHARS = 1 << 21
#: Characters handed to a tokenizer's library at once.
CALL_CHARS = 1 << 18
#: Words whose ids a worker remembers, and the longest of them; a full memo is emptied.
WORDS_KEPT, LONGEST_KEPT = 1 << 19, 64
#: Characters that some library takes for white space and Python does not.
ODD_BLANKS = "\u180e\u200b\ufeff"

PER_DOCUMENT = ["n_a", "n_b", "n_groups", "n_links"]
BLOCKS = (
    "block long, ids binary, nulls binary, " + ", ".join(f"{name} binary" for name in PER_DOCUMENT)
    + ", groups_sha256 array<string>, same_sizes binary, same_ids binary, same_times binary, "
    "other_sizes binary, other_places binary, other_times binary, pairs array<long>, holders array<int>, same_holders array<int>"
)
SUMMARY = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _packed(values, kind: str = "<u4") -> bytes:
    return np.asarray(values, dtype=np.int64).astype(kind).tobytes()


def _flat(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all parts in a row, and how many each has."""
    sizes = np.fromiter(map(len, packed), dtype=np.int64, count=len(packed)) // 4
    return np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int64), sizes


class Aligner:
    """Aligns the tokens of vocabulary A (byte-level BPE, a ``tokenizers`` file) with those of
    vocabulary B (a ``sentencepiece`` model)."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task for each core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.b = SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = self._bytes_a(path_a), self._bytes_b()
        self.width_a, self.width_b = len(self.bytes_a), len(self.bytes_b)
        self.sizes_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.sizes_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        # of pieces with the same bytes the plain one counts, not the fallback for a byte
        id_of = {x: i for i, x in sorted(enumerate(self.bytes_b), key=lambda e: not self.b.is_byte(e[0]))}
        # whether blanks in a piece of B stand at its start alone, so that words do not touch
        self.by_word = not any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.width_b))
        self.known_a: dict[str, bytes] = {}
        self.known_b: dict[str, bytes] = {}
        self.lossy: set[str] = set()
        #: The id in B with the bytes of each id in A, or -1.
        self.same = np.array([id_of.get(x, -1) for x in self.bytes_a], dtype=np.int64)
        self.words = np.array(
            [f"{i}{mark}" for mark in ",|" for i in range(self.width_a)]
            + [f"{i}{mark}" for mark in ",;" for i in range(self.width_b)], dtype=object
        )

    def _bytes_a(self, path: str) -> list[bytes]:
        with open(path, encoding="utf-8") as file:
            parsed = json.load(file)
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        found = [b""] * (max(self.a.get_vocab(with_added_tokens=True).values()) + 1)
        for token, number in parsed["model"]["vocab"].items():
            found[number] = bytes(byte_of[x] for x in token) if all(x in byte_of for x in token) else token.encode()
        for added in parsed["added_tokens"]:
            found[added["id"]] = added["content"].encode()
        return found

    def _bytes_b(self) -> list[bytes]:
        model = self.b
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        return [
            bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(pieces)
        ]

    def _library_ids(self, texts: list[str]) -> tuple[list, list]:
        ids_a, ids_b = [], []
        for part in _by_size(texts, CALL_CHARS):
            encoded = self.a.encode_batch_fast([f" {x}" for x in part], add_special_tokens=False)
            ids_a += [x.ids for x in encoded]
            ids_b += self.b.encode(part, num_threads=1)
        return ids_a, ids_b

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of some words, packed; words that are not given back are noted as lossy."""
        plain = [f" {word}".encode() for word in words]
        sizes = np.fromiter(map(len, plain), dtype=np.int64, count=len(plain))
        for ids, table, widths, known in zip(
            self._library_ids(words), (self.bytes_a, self.bytes_b), (self.sizes_a, self.sizes_b), (self.known_a, self.known_b)
        ):
            counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            flat = np.fromiter(chain.from_iterable(ids), dtype="<u4", count=counts.sum())
            ends, packed = counts.cumsum(), flat.tobytes()
            known.update(zip(words, (packed[4 * start : 4 * end] for start, end in zip((ends - counts).tolist(), ends.tolist()))))
            given = np.concatenate(([0], widths[flat].cumsum()))[ends]
            if (given == sizes.cumsum()).all() and b"".join(map(table.__getitem__, flat.tolist())) == b"".join(plain):
                continue
            self.lossy.update(
                word for word, mine, text in zip(words, ids, plain) if b"".join(map(table.__getitem__, mine)) != text
            )
        self.lossy.update(word for word in words if not word)

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """The ids of all texts in A and in B, packed; none for a text that either does not give back.

        No token of either reaches over a single blank from one word into the next, so a word's ids
        are the same wherever it stands, and are remembered. A text with other white space beside a
        blank, or with the sign that B writes for one, goes to the libraries as a whole.
        """
        if len(self.known_a) >= WORDS_KEPT:
            self.known_a.clear()
            self.known_b.clear()
            self.lossy.clear()
        words = [text.split(" ") if self.by_word else [text] for text in texts]
        fresh = set().union(*words).difference(self.known_a)
        tied = {word for word in fresh if not _stands_alone(word)}
        if tied:
            words = [part if tied.isdisjoint(part) else [text] for part, text in zip(words, texts)]
            tied = {part[0] for part in words if len(part) == 1 and not _stands_alone(part[0])}
            fresh = set().union(*words).difference(self.known_a)
        self._learn(list(fresh))
        found_a, found_b = [], []
        for part in words:
            kept = part if self.lossy.isdisjoint(part) else []
            found_a.append(b"".join(map(self.known_a.__getitem__, kept)))
            found_b.append(b"".join(map(self.known_b.__getitem__, kept)))
        for word in fresh:
            if len(word) > LONGEST_KEPT or word in tied:
                del self.known_a[word], self.known_b[word]
                self.lossy.discard(word)
        return found_a, found_b

    def align(self, texts: list[str]) -> Alignment:
        return Alignment(self, texts)


class Alignment:
    """The aligned tokens of some texts, which lie one behind the other in one row of bytes.

    ``groups`` are the stretches between byte offsets where tokens of both end, ``links`` the pairs of
    an A and a B token that share bytes: between any two neighbouring ends, whosesoever, lies
    just one of them.
    """

    def __init__(self, aligner: Aligner, texts: list[str]):
        self.aligner = aligner
        ids_a, ids_b = aligner.encode(texts)
        (self.a, self.n_a), (self.b, self.n_b) = _flat(ids_a), _flat(ids_b)
        del ids_a, ids_b
        ends_a, ends_b = aligner.sizes_a[self.a].cumsum(), aligner.sizes_b[self.b].cumsum()
        self.shared_a, self.shared_b = _members(ends_a, ends_b), _members(ends_b, ends_a)
        self.group_a = self.shared_a.cumsum() - self.shared_a
        self.group_b = self.shared_b.cumsum() - self.shared_b
        document_a = np.repeat(np.arange(len(texts)), self.n_a)
        self.n_groups = np.bincount(document_a[self.shared_a], minlength=len(texts))
        ends = np.sort(np.concatenate([ends_a, ends_b[~self.shared_b]]), kind="stable")
        at = np.searchsorted(ends_a, ends)
        self.link_a, self.link_b = self.a[at], self.b[np.searchsorted(ends_b, ends)]
        self.link_document = document_a[at]
        self.n_links = np.bincount(self.link_document, minlength=len(texts))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The different linked pairs of each text: its number, the pair as one number, how often."""
        width = self.aligner.width_a * self.aligner.width_b
        keys = self.link_document * width + self.link_a * self.aligner.width_b + self.link_b
        keys, times = np.unique(keys, return_counts=True)
        return keys // width, keys % width, times

    def groups(self) -> list[str]:
        """The groups of each text as ``a1,a2|b1;a3|b2``."""
        total = len(self.shared_a) + len(self.shared_b)
        in_a = np.bincount(self.group_a, minlength=self.shared_a.sum())
        in_b = np.bincount(self.group_b, minlength=self.shared_a.sum())
        width_a, width_b = self.aligner.width_a, self.aligner.width_b
        merged = np.empty(total, dtype=np.int64)
        merged[np.arange(len(self.a)) + (in_b.cumsum() - in_b)[self.group_a]] = self.a + width_a * self.shared_a
        merged[np.arange(len(self.b)) + in_a.cumsum()[self.group_b]] = 2 * width_a + self.b + width_b * self.shared_b
        ends = (self.n_a + self.n_b).cumsum().tolist()
        words = self.aligner.words[merged].tolist()
        return ["".join(words[start:end])[:-1] for start, end in zip([0, *ends], ends)]


def _stands_alone(word: str) -> bool:
    """Whether blanks around a word are no part of longer white space."""
    return bool(word) and "▁" not in word and not (
        word[0].isspace() or word[-1].isspace() or word[0] in ODD_BLANKS or word[-1] in ODD_BLANKS
    )


def _members(values: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which of the sorted ``values`` are among the sorted ``others``."""
    if not len(others):
        return np.zeros(len(values), dtype=bool)
    return others[np.minimum(np.searchsorted(others, values), len(others) - 1)] == values


def _by_size(texts: list[str], chars: int) -> Iterator[list[str]]:
    """The texts in turn, in lists of about ``chars`` characters, one text at least."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > chars:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """The aligner of two vocabulary files, built once in each worker."""
    return Aligner(path_a, path_b)


def _paths(path_a: str | None, path_b: str | None) -> tuple[str, str]:
    return path_a or public_tokenizers.path(VOCABULARY_A), path_b or public_tokenizers.path(VOCABULARY_B)


def align(documents: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """All columns of ``documents`` and ``groups``, the aligned ids of the text as ``a1,a2|b1;a3|b2``.

    A text that is null or empty, or which the tokens of A or B do not give back byte for byte
    (with the blank put before it), has the groups ''. A column of that name is replaced. Texts
    of any length are aligned whole; every row stands for itself; no rows give no rows.
    """
    paths = _paths(path_a, path_b)

    @F.pandas_udf("string")
    def grouped(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            made = []
            for texts in _by_size([x or "" for x in part], BLOCK_CHARS):
                made += aligner(*paths).align(texts).groups()
            yield pd.Series(made, dtype=object)

    return documents.withColumn("groups", grouped("text"))


def _block(number: int, held: list[tuple], made: Aligner, same_holders: np.ndarray) -> dict:
    """A block of documents (id, whether it is null, text) as one row of ``BLOCKS``; adds the documents
    that hold an identical pair to the vector ``same_holders``."""
    ids, nulls, texts = zip(*held)
    found = made.align(list(texts))
    document, pair, times = found.pairs()
    a, b = np.divmod(pair, made.width_b)
    same = made.same[a] == b
    same_holders += np.bincount(a[same], minlength=made.width_a)
    pairs, places, holders = np.unique(pair[~same], return_inverse=True, return_counts=True)
    digests = [sha256(x.encode()).hexdigest() if x else "" for x in found.groups()]
    return {
        "block": number, "ids": _packed(ids, "<i8"), "nulls": _packed(nulls, "u1"),
        **{name: _packed(getattr(found, name), "<i8") for name in PER_DOCUMENT}, "groups_sha256": digests,
        "same_sizes": _packed(np.bincount(document[same], minlength=len(ids))),
        "same_ids": _packed(a[same]), "same_times": _packed(times[same]),
        "other_sizes": _packed(np.bincount(document[~same], minlength=len(ids))),
        "other_places": _packed(places), "other_times": _packed(times[~same]),
        "pairs": pairs, "holders": holders.astype(np.int32), "same_holders": None,
    }


def blocks(documents: DataFrame, path_a: str | None = None, path_b: str | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents aligned, in rows of about ``block_chars`` characters, as a written table.

    A row holds, for each of its documents, the linked pairs: those of ids with the same bytes by
    their A id, the others by their place among the row's ``pairs``. ``holders`` says how many of
    the row's documents hold each of these. How many hold each pair of same bytes is added up in one
    vector as long as vocabulary A, which is a row of its own (without block) for each task.
    """
    paths = _paths(path_a, path_b)

    def packed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        made = aligner(*paths)
        number = TaskContext.get().partitionId() << 32
        same_holders = np.zeros(made.width_a, dtype=np.int64)
        held, size = [], 0

        def row() -> pd.DataFrame:
            return pd.DataFrame([_block(number, held, made, same_holders)])

        for part in parts:
            for entry in zip(part["id"], part["is_null"], part["text"]):
                if held and size + len(entry[2]) > block_chars:
                    yield row()
                    number, held, size = number + 1, [], 0
                held.append(entry)
                size += len(entry[2])
        if held:
            yield row()
            empty = dict.fromkeys(name.split()[0] for name in BLOCKS.split(", "))
            yield pd.DataFrame([empty | {"same_holders": same_holders.astype(np.int32)}]).astype({"block": "Int64"})

    rows = documents.select(
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), F.col("doc_id").isNull().alias("is_null"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return stage(rows.mapInPandas(packed, BLOCKS), "aligned")


def _same_counts(aligned: DataFrame) -> DataFrame:
    """(a, n): how many documents hold the A id linked with the B id of the same bytes."""
    vectors = aligned.filter("block IS NULL").select(F.posexplode("same_holders").alias("a", "n")).filter("n > 0")
    return vectors.groupBy("a").agg(F.sum("n").alias("n"))


def _met(aligned: DataFrame) -> DataFrame:
    """(block, pair, n): the other pairs of each block and how many of its documents hold them."""
    met = F.explode(F.arrays_zip("pairs", "holders")).alias("met")
    return aligned.filter("block IS NOT NULL").select("block", met).select("block", "met.pairs", "met.holders").toDF("block", "pair", "n")


def pair_counts(documents: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """(a, b, n): how many documents hold a token of the A id linked with one of the B id."""
    paths = _paths(path_a, path_b)
    made = aligner(*paths)
    aligned = blocks(documents, *paths)
    # bounded by vocabulary A
    same = documents.sparkSession.createDataFrame(pd.DataFrame({"a": np.arange(made.width_a, dtype=np.int32), "b": made.same}))
    other = _met(aligned).groupBy("pair").agg(F.sum("n").alias("n")).select(
        F.expr(f"CAST(pair DIV {made.width_b} AS INT)").alias("a"), (F.col("pair") % made.width_b).alias("b"), "n"
    )
    return _same_counts(aligned).join(same, "a").select("a", "b", "n").unionByName(other)


def summarize(documents: DataFrame, path_a: str | None = None, path_b: str | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per document the ``SUMMARY``: sizes of its alignment, and how its links stand in the corpus.

    The count of a pair of ids is the number of documents that hold it linked. ``n_best`` counts a
    document's links whose pair is the most frequent one of its A id, ties included; ``count_sum``
    adds up the counts over its links. Pairs of ids with the same bytes are counted in vectors as long
    as vocabulary A, which come to the driver and go to all tasks. Only other pairs are
    shuffled, once for each block that has them.

    Texts that are null or empty, or which the tokens do not give back, have zeros and the digest
    ''. Every row stands for itself, so rows that repeat an id count as documents of their own. A
    long text is a block of its own. Other columns are not read; no rows give no rows.
    """
    paths = _paths(path_a, path_b)
    width_a, width_b = aligner(*paths).width_a, aligner(*paths).width_b
    aligned = blocks(documents, *paths, block_chars=block_chars)
    met = _met(aligned)
    counts = stage(met.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    same_counts, best = np.zeros(width_a, dtype=np.int64), np.zeros(width_a, dtype=np.int64)
    for a, n in _same_counts(aligned).collect():  # one row for each id of A at most
        same_counts[a] = n
    best += same_counts
    most = counts.groupBy(F.expr(f"CAST(pair DIV {width_b} AS INT)").alias("a")).agg(F.max("n").alias("n"))
    for a, n in most.collect():  # likewise
        best[a] = max(best[a], n)

    def answered(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if block.empty:
            return pd.DataFrame({name.split()[0]: [] for name in SUMMARY.split(", ")})
        row = block.iloc[0]
        part = {name: np.frombuffer(value, dtype="<u4").astype(np.int64) for name, value in row.items() if name.startswith(("same_", "other_"))}
        answers = answers.sort_values("pair")
        n, a = answers["n"].to_numpy(dtype=np.int64), answers["pair"].to_numpy(dtype=np.int64) // width_b
        n_best, count_sum = 0, 0
        for sizes, times, count, top in (
            (part["same_sizes"], part["same_times"], same_counts[part["same_ids"]], best[part["same_ids"]]),
            (part["other_sizes"], part["other_times"], n[part["other_places"]], best[a[part["other_places"]]]),
        ):
            ends = sizes.cumsum()
            for_best, for_sum = ([0, *x.cumsum()] for x in (times * (count == top), times * count))
            for_best, for_sum = np.array(for_best), np.array(for_sum)
            n_best, count_sum = n_best + for_best[ends] - for_best[ends - sizes], count_sum + for_sum[ends] - for_sum[ends - sizes]
        ids, nulls = np.frombuffer(row["ids"], dtype="<i8"), np.frombuffer(row["nulls"], dtype="u1")
        return pd.DataFrame({
            "doc_id": pd.arrays.IntegerArray(ids.copy(), nulls.astype(bool)),
            **{name: np.frombuffer(row[name], dtype="<i8") for name in PER_DOCUMENT},
            "n_best": n_best, "count_sum": count_sum, "groups_sha256": row["groups_sha256"],
        })

    answers = met.select("block", "pair").join(counts, "pair")
    rows = aligned.filter("block IS NOT NULL").drop("pairs", "holders", "same_holders")
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(answered, SUMMARY)


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
