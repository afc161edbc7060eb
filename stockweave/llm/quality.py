"""A quality classifier without hand-made labels: heuristics vote, a model of their accuracies weighs
the votes, and the outcome trains a hashed linear scorer."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import and_, eq
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm.frames import read, stage, text_batches

BAD, GOOD, ABSTAIN = 0, 1, 2
DIMENSIONS = 1 << 14
SAMPLE = 20_000
THRESHOLD = 0.5
#: Weight of the first belief on the labellers, as a share of the table.
BELIEF = 0.2

UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(128, 256))  # bytes of other scripts count as letters
SYMBOLS = b"#$%&*|@^~<>{}[]=_\\+"
#: Letters, digits and the rest of a text as one letter for each kind.
KINDS = bytes(
    65 if b in UPPER else 97 if b in LETTERS else 48 if 48 <= b < 58 else b for b in range(256)
)
RUNS = re.compile(rb"([^\s])\1+")


NOT_ALNUM_OR_SPACE = bytes(set(range(256)) - set(LETTERS) - set(b"0123456789 \t\n\r\x0b\x0c"))


def measures(raw: bytes) -> dict[str, float]:
    """What describes a text with at least one word: shares of its words, letters or characters,
    the mean length and the number of its words."""
    words = raw.lower().split()
    count, size = len(words), len(raw)
    letters = size - len(raw.translate(None, LETTERS))
    plain = raw.translate(None, NOT_ALNUM_OR_SPACE)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    repeated = sum(len(line) * (n - 1) for line, n in Counter(lines).items())
    echoes = list(map(eq, words, words[1:]))
    return {
        "symbols": min(1.0, (size - len(raw.translate(None, SYMBOLS))) / count),
        "bare": 1 - len(plain.split()) / count,
        "alnum": len(b"".join(plain.split())) / len(b"".join(words)),
        "upper": (size - len(raw.translate(None, UPPER))) / max(letters, 1),
        "shouts": min(1.0, raw.count(b"!") / count),
        "echo": sum(echoes) / count,
        "runs": sum(map(and_, echoes, echoes[1:])) / count,
        "distinct": len(set(words)) / count,
        "lines": repeated / max(size, 1),
        "length": letters / count,
        "words": count,
    }


@dataclass(frozen=True)
class Labeller:
    """Votes BAD beyond one bound of a measure and GOOD beyond the other; between them, and on texts
    of fewer words than it needs, it abstains."""

    measure: str
    bad: float
    good: float
    words: int = 1

    def vote(self, found: dict[str, float]) -> int:
        if found["words"] < self.words:
            return ABSTAIN
        value, sign = found[self.measure], 1 if self.bad > self.good else -1
        return BAD if sign * value > sign * self.bad else GOOD if sign * value < sign * self.good else ABSTAIN


LABELLERS = (
    Labeller("symbols", bad=0.3, good=0.1, words=5),
    Labeller("bare", bad=0.2, good=0.05, words=5),
    Labeller("alnum", bad=0.8, good=0.9, words=5),
    Labeller("upper", bad=0.4, good=0.2, words=5),
    Labeller("shouts", bad=0.25, good=0.05, words=5),
    Labeller("echo", bad=0.2, good=0.05, words=20),
    Labeller("runs", bad=0.1, good=0.02, words=20),
    Labeller("distinct", bad=0.15, good=0.25, words=50),
    Labeller("lines", bad=0.4, good=0.2, words=20),
)


def pattern(found: dict[str, float] | None, labellers: tuple = LABELLERS) -> int:
    """The votes on a text as one number, a digit to the base 3 for each labeller; all abstain on
    a text without words (None)."""
    votes = [labeller.vote(found) if found else ABSTAIN for labeller in labellers]
    return sum(vote * 3**j for j, vote in enumerate(votes))


def describe(text: str | None) -> dict[str, float] | None:
    """The measures of a text, None if it has no words."""
    raw = (text or "").encode()
    return measures(raw) if raw.strip() else None


def features(text: str | None, found: dict[str, float] | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features: the shares of the text's word shapes, and which tenth each measure is in."""
    if found is None:
        return np.zeros(0, dtype=np.int32), np.zeros(0)
    shapes = Counter(RUNS.sub(rb"\1", text.encode().translate(KINDS)).split())
    places = [crc32(shape) % DIMENSIONS for shape in shapes]
    values = [(n / found["words"]) ** 0.5 for n in shapes.values()]
    for name, value in found.items():
        tenth = int(min(value, 1) * 10) if name not in ("words", "length") else int(np.log2(value + 1))
        places.append(crc32(f"{name} {tenth}".encode()) % DIMENSIONS)
        values.append(0.5)
    return np.array(places, dtype=np.int32), np.array(values)


@dataclass(frozen=True)
class VoteModel:
    """The share of good texts, and rates[class, labeller], how often a labeller that votes on a text
    of a class votes BAD. Abstaining says nothing."""

    good: float
    rates: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The probability of a good text for each row of votes."""
        likely = (votes == BAD) @ np.log(self.rates).T + (votes == GOOD) @ np.log1p(-self.rates).T
        return 1 / (1 + np.exp(np.clip(likely[:, BAD] - likely[:, GOOD], -700, 700)) * (1 - self.good) / self.good)


def votes_of(patterns: np.ndarray, labellers: int) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(labellers) % 3


def fit_votes(patterns: np.ndarray, counts: np.ndarray, labellers: int, rounds: int = 100, trust: float = BELIEF) -> VoteModel:
    """Expectation-maximisation over the counts of vote patterns.

    Starts from and leans on the belief that a labeller seldom votes against a good text and often
    enough against a bad one; the weight of that belief is a share of the table, so that tables of
    every size are treated alike.
    """
    votes = votes_of(patterns, labellers)
    belief = np.empty((2, labellers))
    belief[BAD], belief[GOOD] = 0.33, 0.005
    weight = trust * counts.sum() + 1
    model = VoteModel(0.85, belief)
    for _ in range(rounds):
        good = model.posterior(votes)
        against, cast = np.empty((2, labellers)), np.empty((2, labellers))
        for kind, share in ((BAD, counts * (1 - good)), (GOOD, counts * good)):
            against[kind], cast[kind] = share @ (votes == BAD), share @ (votes != ABSTAIN)
        share = (counts @ good + 0.85 * weight) / (counts.sum() + weight)
        model = VoteModel(float(share), (against + belief * weight) / (cast + weight))
    return model


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Weights of a logistic regression on soft labels, the bias last; full-batch Adagrad."""
    owner = np.repeat(np.arange(len(rows)), [len(places) for places, _ in rows])
    places = np.concatenate([p for p, _ in rows]) if rows else np.zeros(0, dtype=np.int32)
    values = np.concatenate([v for _, v in rows]) if rows else np.zeros(0)
    weights, squares = np.zeros(DIMENSIONS + 1), np.full(DIMENSIONS + 1, 1e-8)
    # both classes weigh the same
    balance = np.where(labels > 0.5, 0.5 / max((labels > 0.5).mean(), 1e-6), 0.5 / max((labels <= 0.5).mean(), 1e-6)) if len(rows) else labels
    for _ in range(rounds if rows else 0):
        margin = np.bincount(owner, values * weights[places], minlength=len(rows)) + weights[-1]
        error = balance * (1 / (1 + np.exp(-margin)) - labels) / len(rows)
        slope = np.append(np.bincount(places, values * error[owner], minlength=DIMENSIONS), error.sum())
        slope[:-1] += 1e-5 * weights[:-1]
        squares += slope**2
        weights -= 0.5 * slope / np.sqrt(squares)
    return weights


@dataclass(frozen=True)
class QualityModel:
    votes: VoteModel
    labellers: tuple
    weights: np.ndarray

    def score(self, text: str | None, found: dict[str, float] | None) -> float:
        places, values = features(text, found)
        if not len(places):
            return 0.0
        return float(1 / (1 + np.exp(-(values @ self.weights[places] + self.weights[-1]))))


def _pattern_column(labellers: tuple):
    @F.pandas_udf("int")
    def voted(texts: pd.Series) -> pd.Series:
        return pd.Series([pattern(describe(x), labellers) for x in texts], dtype="int32")

    return voted


def train(documents: DataFrame, labellers: tuple = LABELLERS, sample: int = SAMPLE) -> QualityModel:
    """The model of ``documents`` (doc_id, text).

    The votes of all documents are counted by pattern, at most 3 to the power of the number of
    labellers. The scorer is trained on a bounded sample: the ``sample`` documents with the
    smallest hashes of doc_id and text.
    """
    voted = stage(text_batches(documents).select(
        "doc_id", F.xxhash64("doc_id", "text").alias("place"), _pattern_column(labellers)("text").alias("pattern")
    ), "votes")
    counted = voted.groupBy("pattern").count().orderBy("pattern").toPandas()
    model = fit_votes(counted["pattern"].to_numpy(), counted["count"].to_numpy(dtype=float), len(labellers))

    chosen = voted.orderBy("place").limit(sample).agg(F.max("place")).first()[0]
    described = _described(documents.filter(F.xxhash64("doc_id", "text") <= F.lit(chosen)), labellers).orderBy("place").limit(sample).toPandas()
    rows = [
        (np.frombuffer(p, dtype=np.int32), np.frombuffer(v, dtype=np.float64))
        for p, v in zip(described["places"], described["values"])
    ]
    soft = model.posterior(votes_of(described["pattern"].to_numpy(dtype=np.int64), len(labellers)))
    return QualityModel(model, labellers, fit_scorer(rows, soft))


def _described(documents: DataFrame, labellers: tuple) -> DataFrame:
    def rows_of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = [describe(x) for x in part["text"]]
            made = [features(x, f) for x, f in zip(part["text"], found)]
            yield pd.DataFrame({
                "place": part["place"], "pattern": [pattern(f, labellers) for f in found],
                "places": [p.tobytes() for p, _ in made], "values": [v.tobytes() for _, v in made],
            })

    rows = documents.select(F.xxhash64("doc_id", "text").alias("place"), "text")
    return rows.mapInPandas(rows_of, "place long, pattern int, places binary, values binary")


def quality_column(model: QualityModel):
    """A column function: quality (the scorer's probability) and posterior (the vote model's)."""

    @F.pandas_udf("quality double, posterior double")
    def scored(texts: pd.Series) -> pd.DataFrame:
        found = [describe(x) for x in texts]
        patterns = np.array([pattern(f, model.labellers) for f in found], dtype=np.int64)
        posterior = model.votes.posterior(votes_of(patterns, len(model.labellers)))
        return pd.DataFrame({"quality": [model.score(x, f) for x, f in zip(texts, found)], "posterior": posterior})

    return scored


def classify(documents: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, quality, posterior and kept (quality >= threshold) of every row of ``documents``.

    A null, empty or blank text has no word to judge: its quality is 0 and it is not kept, its
    posterior is the share of good texts. Every row stands for itself; other columns are not read.
    """
    scored = text_batches(documents).select("doc_id", quality_column(model)("text").alias("scored"))
    return scored.select("doc_id", "scored.quality", "scored.posterior", (F.col("scored.quality") >= threshold).alias("kept"))


def kept_documents(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents``, whole, that the classifier trained on them keeps."""
    model = train(documents.select("doc_id", "text"))
    rows = documents.select(F.struct("*").alias("row"), quality_column(model)("text").alias("scored"))
    return rows.filter(F.col("scored.quality") >= threshold).select("row.*")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return classify(documents, train(documents))
