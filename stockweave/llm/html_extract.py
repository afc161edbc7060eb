"""Main text of web pages: boosted trees judge the blocks, and the tree of blocks settles the rest."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm import boosting, html_training
from stockweave.llm.boosting import Boosted
from stockweave.llm.frames import read, text_batches
from stockweave.llm.html_tree import Block, PageTree, features

TRAINING_PAGES = 3000
SEED = 5


def labels(blocks: list[Block], texts: list[str]) -> np.ndarray:
    """Of a training page: whether a block or one in it holds main text. An unmarked block is like
    its parent. A block without any text, or in one without main text, is no example (-1): the model
    says how likely a block holds main text if its parent does."""
    own = np.zeros(len(blocks), dtype=np.int64)
    filled = np.array([bool(t) for t in texts])
    for i, block in enumerate(blocks):
        own[i] = block.main if block.main is not None else own[block.parent] if i else 1
    found = np.where(filled, own, 0)
    for i in range(len(blocks) - 1, 0, -1):
        found[blocks[i].parent] = max(found[blocks[i].parent], found[i])
        filled[blocks[i].parent] |= filled[i]
    asked = np.array([i == 0 or found[block.parent] == 1 for i, block in enumerate(blocks)])
    return np.where(filled & asked, found, -1)


@lru_cache(maxsize=2)
def train(pages: int = TRAINING_PAGES, seed: int = SEED) -> Boosted:
    """The block classifier, trained on a fixed number of made-up pages."""
    rows, marks = [], []
    for html in html_training.pages(pages, seed):
        blocks = PageTree(html).blocks
        texts = [b.text() for b in blocks]
        rows.append(features(blocks, texts))
        marks.append(labels(blocks, texts))
    rows, marks = np.concatenate(rows), np.concatenate(marks)
    return boosting.fit(rows[marks >= 0], marks[marks >= 0])


def decode(blocks: list[Block], texts: list[str], margin: np.ndarray) -> np.ndarray:
    """Which blocks are kept: the likeliest choice in which nothing below a dropped block is kept.

    ``margin`` has the log-odds of each block if its parent is kept. From the leaves up: dropping a
    block settles all in it, keeping it leaves each child its own best choice. Blocks without text
    have no say, and one that would be kept without anything in it is dropped.
    """
    n = len(blocks)
    filled = np.array([bool(t) for t in texts])
    some = filled.copy()  # whether anything is left if the block is kept
    for i in range(n - 1, 0, -1):
        filled[blocks[i].parent] |= filled[i]
    keep = np.where(filled, -np.logaddexp(0, -margin), 0.0)
    drop = np.where(filled, -np.logaddexp(0, margin), 0.0)
    chosen = np.zeros(n, dtype=bool)
    for i in range(n - 1, -1, -1):
        chosen[i] = some[i] and keep[i] > drop[i]
        if i:
            keep[blocks[i].parent] += max(keep[i], drop[i]) if some[i] else drop[i]
            some[blocks[i].parent] |= chosen[i]
    for i in range(1, n):
        chosen[i] &= chosen[blocks[i].parent]
    return chosen


def extract(pages: list[str | None], model: Boosted) -> list[str]:
    """The main text of each page: its blocks in order, joined by one space."""
    found, rows = [], []
    for html in pages:
        blocks = PageTree(html or "").blocks
        texts = [b.text() for b in blocks]
        found.append((blocks, texts))
        rows.append(features(blocks, texts))
    if not rows:
        return []
    margins = np.split(model.margin(np.concatenate(rows)), np.cumsum([len(r) for r in rows])[:-1])
    return [
        " ".join(text for text, stays in zip(texts, decode(blocks, texts, margin)) if stays and text)
        for (blocks, texts), margin in zip(found, margins)
    ]


def extract_column(model: Boosted, batch_chars: int = 1 << 21):
    """A column function: the main text of an html; about ``batch_chars`` characters of pages (one page
    at least) are judged at once."""

    @F.pandas_udf("string")
    def extracted(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in pages:
            made, held, size = [], [], 0
            for html in part:
                held.append(html)
                size += len(html or "")
                if size >= batch_chars:
                    made += extract(held, model)
                    held, size = [], 0
            yield pd.Series(made + extract(held, model), dtype=object)

    return extracted


def extract_pages(pages: DataFrame, model: Boosted | None = None) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages`` (page_id, url, html).

    A null, empty or blank html, and one without main text, has an empty text. Every row stands for
    itself; other columns are not read. The model is trained on first use, on made-up pages.
    """
    found = text_batches(pages).select("page_id", "url", extract_column(model or train())("html").alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op2_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read(spark, sf_dir, "pages"))
