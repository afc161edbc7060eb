from __future__ import annotations

import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from stockweave.llm import alignment
from tests.llm import tables
from tests.llm.test_tokens import odd_texts

KNOWN: dict = {}
EXTRA = [
    " leading and  double  blanks ", "tab\tand\nline\r\nends", "naïve café – “quoted” … ﬁ ½", "日本語のテキスト と 한국어", "🙂🙃 emoji👩‍👩‍👧",
    "a▁literal sign", "<s> </s> <unk> <0x41> <|endoftext|>", "\x00 null \x7f", "1234567890 3.14159 2024-01-01", "x" * 5_000,
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path(alignment.VOCABULARY_A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.VOCABULARY_B))


def spans(libraries, text):
    """(id, start, end) of the tokens of A and B, or none if either loses a byte."""
    a, b = libraries
    if not text:
        return [], []
    letters = {letter: bytes([byte]) for byte, letter in enumerate(alignment.byte_letters())}
    found = []
    for ids, token_bytes in (
        (a.encode(" " + text, add_special_tokens=False).ids, lambda i: b"".join(letters[x] for x in a.id_to_token(i))),
        (b.encode(text), lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()),
    ):
        at, tokens, whole = 0, [], b""
        for i in ids:
            value = token_bytes(i)
            tokens.append((i, at, at + len(value)))
            at, whole = at + len(value), whole + value
        if whole != (" " + text).encode():
            return [], []
        found.append(tokens)
    return found[0], found[1]


def slow_alignment(libraries, text):
    """Groups as text and links, by comparing offsets."""
    if text in KNOWN:
        return KNOWN[text]
    a, b = spans(libraries, text)
    shared = {end for _, _, end in a} & {end for _, _, end in b}
    sides = []
    for side in (a, b):
        sides.append([[]])
        for i, _, end in side:
            sides[-1][-1].append(str(i))
            if end in shared:
                sides[-1].append([])
    groups = [",".join(x) + "|" + ",".join(y) for x, y in zip(*sides) if x]
    assert len(groups) == len(shared)
    links, first = [], 0
    for i, s, e in a:
        while first < len(b) and b[first][2] <= s:
            first += 1
        at = first
        while at < len(b) and b[at][1] < e:
            links.append((i, b[at][0]))
            at += 1
    KNOWN[text] = len(a), len(b), ";".join(groups), links
    return KNOWN[text]


def slow_summary(libraries, rows):
    aligned = [slow_alignment(libraries, text) for _, text, *_ in rows]
    counts = Counter(pair for *_, links in aligned for pair in set(links))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return sorted((
        (row[0], n_a, n_b, groups.count(";") + 1 if groups else 0, len(links), sum(counts[x] == best[x[0]] for x in links),
         sum(counts[x] for x in links), sha256(groups.encode()).hexdigest() if groups else "")
        for row, (n_a, n_b, groups, links) in zip(rows, aligned)), key=str), counts


def rows_of_all_kinds():
    texts = odd_texts()[::5] + EXTRA
    return tables.odd_rows() + [(5_000 + i, text, "s") for i, text in enumerate(texts)]


def test_groups_match_the_definition(libraries):
    texts = [text or "" for _, text, _ in rows_of_all_kinds()]
    paths = alignment._paths(None, None)
    assert alignment.aligner(*paths).align(texts).groups() == [slow_alignment(libraries, text)[2] for text in texts]


def test_words_encode_alike_alone_and_in_texts(libraries, monkeypatch):
    """Remembered words against whole texts, with a memo that is always full and words too long for it."""
    generator = random.Random(6)
    marks = ["a", "Zebra's", "x,", "(1", "ä", "日本", "\n", "\t", " ", "\u00a0", "\u200b", "\x1c", "\x85", "\u180e", "\u3000", "▁", "<s>", "🙂", "don't", "-", "9" * 70]
    texts = [" ".join(generator.choices(marks, k=generator.randint(1, 12))) for _ in range(3_000)]
    made = alignment.Aligner(*alignment._paths(None, None))
    assert made.by_word
    for kept in (1, alignment.WORDS_KEPT):
        monkeypatch.setattr(alignment, "WORDS_KEPT", kept)
        for at in range(0, len(texts), 250):
            part = texts[at : at + 250]
            whole = zip(part, *made._library_ids(part))
            lost = lambda ids, table, text: not text or b"".join(table[i] for i in ids) != f" {text}".encode()
            expected = [
                (b"", b"") if lost(a, made.bytes_a, text) or lost(b, made.bytes_b, text)
                else (alignment._packed(a), alignment._packed(b)) for text, a, b in whole
            ]
            assert list(zip(*made.encode(part))) == expected
    assert made.known_a and max(map(len, made.known_a)) <= alignment.LONGEST_KEPT


def test_tokens_of_the_same_bytes_are_mapped(libraries):
    made = alignment.aligner(*alignment._paths(None, None))
    mapped = np.flatnonzero(made.same >= 0)
    assert len(mapped) > 5_000
    assert all(made.bytes_a[i] == made.bytes_b[made.same[i]] for i in mapped)
    assert set(made.bytes_a) & set(made.bytes_b) == {made.bytes_a[i] for i in mapped}
    plain = [i for i in mapped if made.b.is_byte(int(made.same[i]))]
    pieces = {x for i, x in enumerate(made.bytes_b) if not made.b.is_byte(i)}
    assert not any(made.bytes_a[i] in pieces for i in plain)


@pytest.mark.parametrize("block_chars", [1, 3_000, alignment.BLOCK_CHARS])
def test_summary_matches_brute_force_at_every_block_size(spark, libraries, block_chars):
    rows = rows_of_all_kinds()
    documents = tables.with_clashes(tables.documents(spark, rows)).repartition(3)
    found = alignment.summarize(documents, block_chars=block_chars)
    assert sorted(map(tuple, found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=str) == slow_summary(libraries, rows)[0]


def test_pair_counts_match_brute_force(spark, libraries):
    rows = rows_of_all_kinds()
    found = alignment.pair_counts(tables.documents(spark, rows).repartition(3))
    assert {(r.a, r.b): r.n for r in found.collect()} == slow_summary(libraries, rows)[1]


def test_aligned_documents_keep_their_columns(spark, libraries):
    rows = rows_of_all_kinds()
    table = tables.with_clashes(tables.documents(spark, rows))
    found = alignment.align(table)
    assert found.columns == [*table.columns, "groups"]
    assert sorted((str(r.doc_id), r.groups) for r in found.collect()) == sorted(
        (str(i), slow_alignment(libraries, text)[2]) for i, text, _ in rows)


def test_empty_tables(spark):
    empty = tables.documents(spark, [])
    assert alignment.summarize(empty).count() == 0
    assert alignment.pair_counts(empty).count() == 0
    assert alignment.align(empty).count() == 0
    nothing = alignment.summarize(tables.documents(spark, [(1, None, None), (2, "", "s")])).collect()
    assert sorted(map(tuple, nothing)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]
