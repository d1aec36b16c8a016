"""Approximate nearest neighbours by multi-index hashing.

Vectors are rotated by rotations learned on a bounded sample (iterative
quantisation, one rotation for every run of bits) and reduced to sign bits.  A
code is split into substrings, each with its own index from substring value to
rows.  If two codes differ in at most ``radius`` bits, then by the pigeonhole
principle some substring differs in few bits: probing every index within that
many bits retrieves every code within the radius.  What it retrieves is
verified on whole codes and reranked by inner products of the original vectors.

Norms enter by the usual reduction: a vector is scaled by the largest norm and
given one more component that makes its length 1, a query's is 0.  The
nearest angle is then the largest inner product.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BITS, SUB = 256, 16            # code bits, bits of a substring
SAMPLE = 4096                  # rows that the rotation and the radius are learned on
SAMPLE_QUERIES = 256
RECALL = 0.97                  # share of the sample's neighbours that the radius covers
SHARD_ROWS, QUERY_ROWS = 4096, 2048


@dataclass
class Codes:
    rotation: np.ndarray  # components (with the added one) x bits
    norm: float
    radius: int

    def encode(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """Rows of uint16 substrings."""
        lifted = _lift(vectors, self.norm, query)
        return np.packbits(lifted @ self.rotation > 0, axis=1).view(np.uint16)


def _lift(vectors: np.ndarray, norm: float, query: bool) -> np.ndarray:
    if query:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.hstack([unit, np.zeros((len(unit), 1))])
    scaled = vectors / norm
    return np.hstack([scaled, np.sqrt(np.maximum(0.0, 1 - (scaled ** 2).sum(axis=1, keepdims=True)))])


def learn_codes(sample: np.ndarray, norm: float, k: int, bits: int = BITS, seed: int = 0, rounds: int = 20) -> Codes:
    """Rotations by iterative quantisation, and the radius that covers ``RECALL``
    of the sample's own k nearest.  The whole table's nearest are nearer than a
    sample's, so the radius errs on the wide side."""
    rng, lifted = np.random.default_rng(seed), _lift(sample, norm, False)
    width = lifted.shape[1]
    parts = []
    for _ in range(math.ceil(bits / width)):
        r = np.linalg.qr(rng.normal(size=(width, width)))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.sign(lifted @ r).T @ lifted)
            r = (u @ v).T
        parts.append(r)
    codes = Codes(np.hstack(parts)[:, :bits], norm, bits)
    if len(sample) - 1 > k:
        queries = sample[:SAMPLE_QUERIES]
        near = np.argsort(-(queries @ sample.T), axis=1, kind="stable")[:, :k + 1]
        far = hamming(codes.encode(queries, True), codes.encode(sample))
        found = np.take_along_axis(far, near, 1)[near != np.arange(len(queries))[:, None]]
        codes.radius = min(bits, int(np.quantile(found, RECALL)) + 1)
    return codes


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between all rows of ``a`` and of ``b`` (substrings)."""
    out = np.zeros((len(a), len(b)), np.int16)
    for s in range(a.shape[1]):
        out += np.bitwise_count(a[:, s, None] ^ b[None, :, s])
    return out


def substring_radii(radius: int, substrings: int) -> list[int]:
    """How far to probe each index: the first ``radius % m + 1`` up to
    ``radius // m`` bits, the others one bit less.  Codes farther than that in
    every substring differ in more than ``radius`` bits."""
    r, a = divmod(radius, substrings)
    return [r] * (a + 1) + [r - 1] * (substrings - a - 1)


def bucket_hits(values: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """Which buckets (sorted distinct substring values) each query's probes reach.

    Probes are enumerated while they are fewer than the buckets; else the
    bucket directory is compared, which reaches the same."""
    if radius < 0:
        return np.zeros((len(queries), len(values)), bool)
    if sum(math.comb(SUB, r) for r in range(min(radius, SUB) + 1)) >= len(values):
        return np.bitwise_count(values[None, :] ^ queries[:, None]) <= radius
    flips = np.array([sum(1 << b for b in chosen) for r in range(radius + 1) for chosen in combinations(range(SUB), r)], np.uint16)
    probes = queries[:, None] ^ flips[None, :]
    at = np.minimum(np.searchsorted(values, probes), len(values) - 1)
    out = np.zeros((len(queries), len(values)), bool)
    row, probe = np.nonzero(values[at] == probes)
    out[row, at[row, probe]] = True
    return out


def within_radius(index: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """Matrix (query, row) of the codes within ``radius``, by the substring indexes."""
    if radius >= index.shape[1] * SUB:
        return np.ones((len(queries), len(index)), bool)
    hits = np.zeros((len(queries), len(index)), bool)
    for s, near in enumerate(substring_radii(radius, index.shape[1])):
        values, bucket = np.unique(index[:, s], return_inverse=True)
        hits |= bucket_hits(values, queries[:, s], near)[:, bucket]
    return hits & (hamming(queries, index) <= radius)


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in rows])


def _searcher(shared, k: int, whole: bool):
    def search(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: dict = {"qid": [], "vec_id": [], "score": []}
        if len(queries) and len(rows):
            codes, vectors = shared.value, _matrix(rows["vector"])
            index, ids = codes.encode(vectors), rows["ids"].to_list()
            for a in range(0, len(queries), 256):
                part = queries.iloc[a:a + 256]
                wanted = _matrix(part["vector"])
                near = within_radius(index, codes.encode(wanted, True), index.shape[1] * SUB if whole else codes.radius)
                for qid, query, mask in zip(part["qid"], wanted, near, strict=True):
                    at = np.flatnonzero(mask)
                    scores = (vectors[at] * query).sum(axis=1)
                    if len(at) > k:  # every class that can hold one of the k + 1 first rows, ties included
                        least = np.partition(scores, len(at) - k - 1)[len(at) - k - 1]
                        at, scores = at[scores >= least], scores[scores >= least]
                    best = sorted((-s, i) for s, r in zip(scores.tolist(), at.tolist(), strict=True) for i in ids[r])[:k + 1]
                    out["qid"] += [qid] * len(best)
                    out["vec_id"] += [i for _, i in best]
                    out["score"] += [-s for s, _ in best]
        return pd.DataFrame(out).astype({"qid": "int64", "vec_id": "int64", "score": "float64"})
    return search


def nearest(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", queries: Column | None = None,
            k: int = 20, bits: int = BITS, seed: int = 0) -> DataFrame:
    """For every query row its ``k`` nearest other rows: ``query_id``, ``rank``, ``vec_id``, ``score``.

    ``queries`` is a condition on the long ``vec_id`` (default: divisible by
    20).  Nearness is the largest inner product in double precision; ties go to the
    smaller id.  All rows are indexed.  Equal vectors are one class, of which
    the ``k + 1`` smallest ids are kept: no other can be among the nearest.
    Shards of the classes meet blocks of the distinct query vectors, so a task
    holds one of each.  A query that finds fewer than ``k`` within the radius
    searches all codes in a second pass.

    Edge cases: null vectors, all-zero ones, those with null or non-finite
    components, rows with a null id and vectors that have not the commonest
    number of components take no part; rows equal in id and vector are one;
    with ``k`` or fewer other rows all are returned; an empty table, or one
    without queries, gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    queries = F.col("vec_id") % 20 == 0 if queries is None else queries
    values = F.col(f"`{vector}`")
    clean = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), values.alias("vector")).where(
        "vec_id is not null and vector is not null and size(vector) > 0") \
        .where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))) \
        .where(F.exists("vector", lambda x: x != 0))
    size = clean.groupBy(F.size("vector").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if size is None:
        return spark.createDataFrame([], schema)
    clean = clean.where(F.size("vector") == size.n).distinct()

    # classes of equal vectors, with their smallest ids (cut before the shuffle)
    place = Window.partitionBy("vector").orderBy("vec_id")
    classes = written(clean.withColumn("n", F.row_number().over(place)).where(F.col("n") <= k + 1)
                      .groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                      .withColumn("norm", F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))))
                      .withColumn("h", F.xxhash64("vector")), "ann-classes")
    rows, norm = classes.agg(F.count(F.lit(1)), F.max("norm")).first()
    sample = classes.orderBy("h", F.element_at("ids", 1)).limit(SAMPLE).select("vector").toPandas()
    shared = spark.sparkContext.broadcast(learn_codes(_matrix(sample["vector"]), norm, k, bits, seed))  # bounded by components x bits

    asked = written(clean.where(queries).join(classes.select("vector", F.element_at("ids", 1).alias("qid")), "vector")
                    .select("vec_id", "qid", "vector"), "ann-queries")
    # the shard and block counts follow the sizes; a group has about the same rows at any size
    distinct = written(asked.groupBy("qid").agg(F.first("vector").alias("vector")), "ann-blocks")
    shards, blocks = math.ceil(rows / SHARD_ROWS), max(1, math.ceil(distinct.count() / QUERY_ROWS))

    def run(wanted: DataFrame, whole: bool) -> DataFrame:
        left = wanted.select("qid", "vector", F.pmod(F.xxhash64("qid"), F.lit(blocks)).alias("block"),
                             F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
        right = classes.select("ids", "vector", F.pmod("h", F.lit(shards)).alias("shard"),
                               F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
        found = left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")) \
            .applyInPandas(_searcher(shared, k, whole), "qid long, vec_id long, score double")
        best = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)

    found = written(run(distinct, False), "ann-found")
    short = distinct.join(found.groupBy("qid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > k), "qid", "left_anti")
    if not short.isEmpty():
        found = found.join(short.select("qid"), "qid", "left_anti").unionByName(run(short, True))
    lists = found.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("best"))
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("vec_id")), 1, k)
    return asked.select("vec_id", "qid").join(lists, "qid") \
        .select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("rank", "b")) \
        .select("query_id", (F.col("rank") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score"))
