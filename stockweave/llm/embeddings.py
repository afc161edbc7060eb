"""Near duplicates among embeddings by binary codes of randomly rotated vectors."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm.components import connected_components
from stockweave.llm.frames import read, stage

THRESHOLD = 0.95
BANDS, BAND_BITS = 32, 16
SEED = 3
#: Width of the confidence bounds, in the unit of the estimate's spread.
WIDTH = 4.0


@lru_cache(maxsize=64)
def rotation(dimensions: int, number: int) -> np.ndarray:
    """A random rotation; rows beyond a vector's own length see zeros."""
    size = padded(dimensions)
    normal = np.random.default_rng([SEED, size, number]).standard_normal((size, size))
    turned, scale = np.linalg.qr(normal)
    return (turned * np.sign(np.diag(scale)))[:, :dimensions]


def padded(dimensions: int) -> int:
    return -(-dimensions // 64) * 64


def unit(vector) -> np.ndarray | None:
    """A vector of length 1 in double precision; None if it has no direction."""
    if vector is None or not len(vector):
        return None
    values = np.array([np.nan if x is None else x for x in vector], dtype=np.float64)
    largest = np.abs(values).max()  # not finite if any component is not
    if not np.isfinite(largest) or largest == 0:
        return None
    values = values / largest
    return values / np.linalg.norm(values)


def most_bits(threshold: float, bits: int = 64) -> int:
    """How many of ``bits`` signs of two vectors at the threshold differ at most, but for chances below
    one in a million: their share is the angle over pi, and a turn by the normal bound."""
    share = np.arccos(threshold) / np.pi
    return min(bits, int(np.ceil(bits * share + 5.5 * np.sqrt(bits * share * (1 - share)))))


def _keyed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        vectors = [unit(x) for x in part["embedding"]]
        keys = [None if v is None else sha256((v + 0.0).tobytes()).digest()[:16] for v in vectors]
        ids = part["has_id"].to_numpy()
        yield pd.DataFrame({
            "vec_id": part["vec_id"], "has_id": ids, "key": [k if has else None for k, has in zip(keys, ids)],
            "vector": [v if has else None for v, has in zip(vectors, ids)],
        })


CODE_SCHEMA = "key binary, n long, vector array<double>, size int, head long, code binary, factor double, bands array<long>"


def _coded(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each vector: the signs of its first rotation and the inner product of the vector with the
    corner of the cube that the signs name, the correction factor; and bands of signs of as many
    rotations as they need."""
    weights = 1 << np.arange(BAND_BITS, dtype=np.int64)
    for part in parts:
        rows = []
        for key, n, vector in zip(part["key"], part["n"], part["vector"]):
            size = padded(len(vector))
            turns = -(-BANDS * BAND_BITS // size)
            turned = np.concatenate([rotation(len(vector), r) @ vector for r in range(turns)])
            signs = turned > 0
            code = np.packbits(signs[:size])
            bands = signs[: BANDS * BAND_BITS].reshape(BANDS, BAND_BITS) @ weights
            rows.append((
                key, n, vector, len(vector), int(code[:8].view(">i8")[0]), code.tobytes(),
                float(np.abs(turned[:size]).sum() / np.sqrt(size)), bands,
            ))
        yield pd.DataFrame(rows, columns=["key", "n", "vector", "size", "head", "code", "factor", "bands"])


def estimate(vector: np.ndarray, code: bytes, factor: float) -> tuple[float, float]:
    """An unbiased estimate of the cosine of ``vector`` and the vector with this code and factor, and
    the spread of the estimate for a vector at a right angle.

    The rotated vector's product with the code's corner of the cube is, up to the factor, the
    cosine and what the rest of the vector adds: that part has a random direction, so it is zero on
    average, with a spread of sqrt((1 - factor^2) / factor^2 / (size - 1)).
    """
    size = padded(len(vector))
    corner = np.unpackbits(np.frombuffer(code, dtype=np.uint8)) * 2.0 - 1.0
    found = (rotation(len(vector), 0) @ vector) @ corner / np.sqrt(size) / factor
    return float(found), float(np.sqrt(max(1 - factor**2, 0.0) / factor**2 / max(size - 1, 1)))


def _screen(threshold: float, width: float):
    """Drops the pairs whose upper confidence bound is below the threshold."""
    def screened(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            stays = []
            for vector, code, factor in zip(part["vector"], part["code"], part["factor"]):
                found, spread = estimate(vector, code, factor)
                # at cosine c only the part of length sqrt(1 - c^2) is random
                stays.append(found + width * spread * np.sqrt(1 - threshold**2) >= threshold)
            yield part[stays][["a", "b", "vector"]]

    return screened


def _exact(threshold: float):
    def checked(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            cosine = np.array([float(x @ y) for x, y in zip(part["vector"], part["other"])])
            yield part[cosine >= threshold][["a", "b"]] if len(part) else part[["a", "b"]]

    return checked


def candidates(codes: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a < b: pairs of vectors of one length that agree in a band and in enough signs."""
    rows = codes.select("key", "head", "size", F.posexplode("bands").alias("band", "signs"))
    other = rows.select(F.col("key").alias("b"), F.col("head").alias("head_b"), "size", "band", "signs")
    near = F.bit_count(F.col("head").bitwiseXOR(F.col("head_b"))) <= most_bits(threshold)
    pairs = rows.join(other, ["band", "signs", "size"]).filter((F.col("key") < F.col("b")) & near)
    return pairs.select(F.col("key").alias("a"), "b").distinct()


def links(codes: DataFrame, threshold: float = THRESHOLD, width: float = WIDTH) -> DataFrame:
    """(a, b), a < b: the keys of the different vectors of ``codes`` with cosine >= threshold."""
    found = candidates(codes, threshold)
    left = found.join(codes.select(F.col("key").alias("a"), "vector"), "a")
    both = left.join(codes.select(F.col("key").alias("b"), "code", "factor"), "b")
    possible = both.select("a", "b", "vector", "code", "factor").mapInPandas(
        _screen(threshold, width), "a binary, b binary, vector array<double>"
    )
    pairs = possible.join(codes.select(F.col("key").alias("b"), F.col("vector").alias("other")), "b")
    return pairs.select("a", "b", "vector", "other").mapInPandas(_exact(threshold), "a binary, b binary")


def near_dedup(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``embeddings`` (vec_id, embedding).

    Vectors of the same direction are one node with a weight. Candidates agree in one of 32 bands of
    16 signs: a pair at cosine 0.95 is found with a chance of 0.998, closer pairs with a higher one.
    The number of signs that differ, the estimate's confidence bounds and the exact cosine in double
    precision decide in turn, so there is no link below the threshold.

    A vector that is null, empty or zero, or has a null or non-finite component, links with nothing;
    nor do vectors of different lengths, nor rows without vec_id, whose component_id is null and
    which are not kept. Rows which repeat a vec_id are vectors of their own. Other columns are not
    read.
    """
    keyed = stage(
        embeddings.select(
            F.coalesce("vec_id", F.lit(0)).alias("vec_id"), F.col("vec_id").isNotNull().alias("has_id"), "embedding"
        ).mapInPandas(_keyed, "vec_id long, has_id boolean, key binary, vector array<double>"), "vectors",
    )
    valid = keyed.filter("key is not null")
    nodes = stage(valid.groupBy("key").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("n"), F.first("vector").alias("vector")), "nodes")
    codes = stage(nodes.select("key", "n", "vector").mapInPandas(_coded, CODE_SCHEMA), "codes")
    linked = stage(links(codes, threshold), "links")

    both = linked.unionByName(linked.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weights = nodes.select(F.col("key").alias("b"), "n")
    others = both.join(weights, "b").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("others"))
    labels = connected_components(linked).withColumnRenamed("node", "key")
    groups = stage(
        nodes.select("key", "n", "first_id").join(others, "key", "left").join(labels, "key", "left")
        .select("key", "first_id", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                F.coalesce("component", "key").alias("label")), "groups",
    )
    names = stage(groups.groupBy("label").agg(F.min("first_id").alias("component_id")), "names")
    named = stage(groups.join(names, "label").select("key", "n_links", "component_id"), "named")
    rows = keyed.select("vec_id", "has_id", "key").join(named, "key", "left")
    vec_id = F.when(F.col("has_id"), F.col("vec_id"))
    component = F.coalesce("component_id", vec_id)
    return rows.select(
        vec_id.alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(vec_id == component, F.lit(False)).alias("kept"),
    )


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(read(spark, sf_dir, "embeddings"))
