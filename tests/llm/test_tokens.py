from __future__ import annotations

import base64
import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from stockweave.llm import byte_bpe, token_counts
from tests.llm import tables


@pytest.fixture(scope="module")
def reference():
    lines = open(public_tokenizers.path(byte_bpe.RANKS), "rb")
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def counter():
    return Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))


def odd_texts():
    generator = random.Random(2)
    ranges = [(32, 127), (0, 0x300), (0, 0x2FFF), (0x4E00, 0x9FFF), (0x1F300, 0x1F64F), (32, 33), (10, 11)]
    texts = ["".join(chr(generator.randrange(*generator.choice(ranges))) for _ in range(generator.randrange(80))) for _ in range(800)]
    texts += ["a" * n for n in range(1, 70)] + ["".join(generator.choices("abcdeinst", k=k)) for k in range(1, 400, 7)]
    texts += ["", " ", "  \n\n x\r\n", "don't I'll we've", "x" * 20_000, "ab" * 3_000, "<|endoftext|>a <|endoftext|> b<|endoftext|>"]
    return texts


def test_ids_are_those_of_the_library(reference):
    codec = byte_bpe.encoder(public_tokenizers.path(byte_bpe.RANKS))
    for text in odd_texts():
        ids = codec.encode(text)
        assert np.frombuffer(ids, dtype="<u4").tolist() == reference.encode_ordinary(text)
        assert byte_bpe.decode(ids, codec.tokens) == text.encode()


def test_every_token_is_its_own_encoding(reference):
    codec = byte_bpe.encoder(public_tokenizers.path(byte_bpe.RANKS))
    for rank in list(codec.halves)[::7]:
        assert codec.merge(codec.tokens[rank]) == [rank]


def test_counts_are_those_of_the_library(counter):
    texts = odd_texts()
    found = token_counts.merger(public_tokenizers.path(token_counts.VOCABULARY)).counts(texts)
    assert found == [len(e.ids) for e in counter.encode_batch(texts, add_special_tokens=False)]


def test_a_full_memo_changes_nothing(monkeypatch, counter, reference):
    monkeypatch.setattr(token_counts, "PIECES_KEPT", 10)
    monkeypatch.setattr(byte_bpe, "PIECES_KEPT", 10)
    monkeypatch.setattr(byte_bpe, "PAIRS_KEPT", 10)
    texts = odd_texts()[:100]
    merger = token_counts.BatchMerger(public_tokenizers.path(token_counts.VOCABULARY))
    codec = byte_bpe.ByteBpe(public_tokenizers.path(byte_bpe.RANKS))
    for text in texts:
        assert merger.counts([text]) == [len(counter.encode(text, add_special_tokens=False).ids)]
        assert np.frombuffer(codec.encode(text), dtype="<u4").tolist() == reference.encode_ordinary(text)


def test_tokenized_documents_keep_their_columns(spark, reference):
    rows = tables.odd_rows()
    table = tables.with_clashes(tables.documents(spark, rows))
    made = byte_bpe.tokenize(table)
    assert made.columns == [*table.columns, "token_ids", "n_tokens"]
    expected = sorted((str(i), t or "", reference.encode_ordinary(t or "")) for i, t, _ in rows)
    found = sorted((str(r.doc_id), r.text or "", np.frombuffer(r.token_ids or b"", dtype="<u4").tolist()) for r in made.collect())
    assert found == expected
    assert all(r.n_tokens == len(r.token_ids) // 4 for r in made.collect())


def test_queries_on_a_small_table(spark, tmp_path, reference, counter):
    rows = tables.odd_rows()
    tables.with_clashes(tables.documents(spark, rows)).write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(map(tuple, byte_bpe.op1_byte_bpe(spark, str(tmp_path)).collect()), key=str)
    pack = lambda ids: np.array(ids, dtype="<u4").tobytes()
    expected = [
        (i, len(ids := reference.encode_ordinary(t or "")), sha256(pack(ids)).hexdigest(), sha256((t or "").encode()).hexdigest())
        for i, t, _ in rows
    ]
    assert found == sorted(expected, key=str)
    counted = sorted(map(tuple, token_counts.op9_token_counts(spark, str(tmp_path)).collect()), key=str)
    lengths = [len(counter.encode(t or "", add_special_tokens=False).ids) for _, t, _ in rows]
    assert counted == sorted(((i, len((t or "").encode()), n, n > 1024) for (i, t, _), n in zip(rows, lengths)), key=str)


def test_decoding_a_column_gives_the_texts_back(spark):
    made = byte_bpe.tokenize(tables.documents(spark, tables.odd_rows()))
    back = made.select("text", byte_bpe.decode_column()("token_ids").alias("decoded")).collect()
    assert all((r.decoded or b"") == (r.text or "").encode() for r in back)


def test_empty_tables(spark):
    empty = tables.documents(spark, [])
    assert byte_bpe.tokenize(empty).count() == 0
    assert token_counts.count_tokens(empty).count() == 0
