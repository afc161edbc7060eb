from __future__ import annotations

import random

import numpy as np
import pytest

from stockweave.llm import quality
from tests.llm import tables


def corpus(seed: int, n: int = 600):
    """Prose, of which one text in six is junk of one of four kinds; (doc_id, text, source), is_junk."""
    generator = random.Random(seed)
    rows, junk = [], []
    for i in range(n):
        words = [generator.choice(tables.WORDS) + str(generator.randrange(90)) * (generator.random() < 0.3) for _ in range(generator.randint(25, 300))]
        kind = generator.randrange(24)
        if kind == 0:
            text = " ".join(w + generator.choice(["###", "$$$", "%%%", "&&&"]) for w in words)
        elif kind == 1:
            text = " ".join(w.upper() + "!!" for w in words)
        elif kind == 2:
            text = " | ".join(words)
        elif kind == 3:
            text = " ".join(w for w in words[:10] for _ in range(12))
        else:
            text = " ".join(words).capitalize() + "."
        rows.append((i, text, "s"))
        junk.append(kind < 4)
    return rows, np.array(junk)


def test_unlabelled_training_tells_junk_from_prose(spark):
    rows, junk = corpus(1)
    model = quality.train(tables.documents(spark, rows).select("doc_id", "text"))
    fresh, fresh_junk = corpus(2)
    found = {r.doc_id: r for r in quality.classify(tables.documents(spark, fresh), model).collect()}
    kept = np.array([found[i].kept for i in range(len(fresh))])
    assert kept[~fresh_junk].all()
    assert (~kept[fresh_junk]).mean() > 0.95
    assert all(0 <= r.quality <= 1 and 0 <= r.posterior <= 1 for r in found.values())


def test_expectation_maximisation_recovers_accuracies():
    generator = np.random.default_rng(3)
    good = generator.random(20_000) < 0.8
    bad_rate = {True: np.array([0.02, 0.01, 0.05, 0.02]), False: np.array([0.8, 0.6, 0.7, 0.9])}
    votes = np.where(generator.random((len(good), 4)) < np.where(good[:, None], bad_rate[True], bad_rate[False]), quality.BAD, quality.GOOD)
    votes[generator.random(votes.shape) < 0.1] = quality.ABSTAIN
    patterns, counts = np.unique(votes @ 3 ** np.arange(4), return_counts=True)
    model = quality.fit_votes(patterns, counts.astype(float), 4, trust=0.005)
    assert model.good == pytest.approx(0.8, abs=0.03)
    assert (model.rates[quality.BAD] > 0.45).all() and (model.rates[quality.GOOD] < 0.06).all()
    found = model.posterior(quality.votes_of(votes @ 3 ** np.arange(4), 4)) >= 0.5
    assert (found == good).mean() > 0.98


def test_odd_rows(spark):
    rows = tables.odd_rows()
    table = tables.with_clashes(tables.documents(spark, rows))
    model = quality.train(table.select("doc_id", "text"))
    found = quality.classify(table, model).collect()
    assert len(found) == len(rows)
    blank = [t is None or not t.strip(" \t\n") for _, t, _ in rows]
    assert sum(r.quality == 0 for r in found) >= sum(blank)
    kept = quality.kept_documents(table)
    assert kept.columns == table.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in found if r.kept)
    assert all(r.text and r.text.strip() for r in kept.collect())


def test_reruns_agree(spark):
    rows, _ = corpus(4, 200)
    table = tables.documents(spark, rows).select("doc_id", "text")
    first, second = (sorted(quality.classify(table.repartition(n), quality.train(table.repartition(n))).collect()) for n in (1, 5))
    assert [(r.doc_id, r.kept) for r in first] == [(r.doc_id, r.kept) for r in second]
    assert [r.quality for r in first] == pytest.approx([r.quality for r in second])


def test_an_empty_table_gives_an_empty_one(spark):
    empty = tables.documents(spark, [])
    assert quality.classify(empty, quality.train(empty.select("doc_id", "text"))).count() == 0
    assert quality.kept_documents(empty).count() == 0


def test_long_word_shapes_are_told_apart():
    """Shapes alike in their first hundred letters and unlike after, as features."""
    start = "aA" * 60
    places = [quality.features(text, quality.describe(text))[0] for text in (f"{start}0", f"{start}-", f"{start}0")]
    assert places[0][0] != places[1][0] and places[0][0] == places[2][0]
