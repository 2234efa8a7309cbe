"""Nearest neighbours by multi-index hashing.

Vectors become binary codes: centred, rotated by learned rotations (iterative quantisation: alternate between the
signs of the rotated sample and the rotation that brings the sample closest to them), one bit per sign. A code is
split into substrings of eight bits, each with an index of its own. Two codes within Hamming distance r agree, in
some substring, up to r / (number of substrings) bits; so probing every substring index at that distance retrieves
every code within r, and nothing within r is missed. Those codes' vectors are ranked by their Euclidean distance in
double precision.

A query that finds fewer than ``k`` codes in a shard probes it again with a larger r.

The rotations and r are fitted on ``sample`` vectors with the smallest hashed ids: r is the ``quantile`` of the
Hamming distances at which the sample's own nearest neighbours lie. All rows are indexed. Rows are dealt over
shards of about ``shard_rows`` by hashed id, queries over blocks, so that a task holds a bounded part of either; the
shards' answers are merged by a window that keeps ``k`` rows per query in every map task.

Rules: vectors that are null, zero, or hold null or non-finite components take no part, nor do those of another
length than the most frequent one; fewer candidates than ``k`` are all returned; ties go to the smaller vec_id, so
many equal vectors need no care; a query never returns its own vec_id; rows without vec_id take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

SUBSTRING_BITS = 8
DISTANCE = np.array([bin(i).count("1") for i in range(256)], np.uint8)[np.arange(256)[:, None] ^ np.arange(256)[None, :]]


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and ``vector`` (doubles) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")).filter(
        F.col("vec_id").isNotNull()
        & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("vector") == (lengths.n if lengths else 0))


class Codes:
    """Learned rotations and the radius."""

    def __init__(self, sample: np.ndarray, bits: int, k: int, quantile: float, iterations: int = 20):
        random = np.random.default_rng(7)
        self.mean = sample.mean(0)
        x = sample - self.mean
        d = x.shape[1]
        axes = np.linalg.svd(x, full_matrices=False)[2] if len(x) > 1 else np.eye(d)
        axes = axes[: max(1, min(d, bits))]
        parts = []
        while sum(p.shape[1] for p in parts) < bits:
            turn = np.linalg.qr(random.standard_normal((len(axes), len(axes))))[0]
            low = x @ axes.T
            for _ in range(iterations):
                u, _, v = np.linalg.svd(np.where(low @ turn >= 0, 1.0, -1.0).T @ low)
                turn = (u @ v).T
            parts.append(axes.T @ turn)
        self.rotation = np.concatenate(parts, axis=1)[:, :bits]
        codes = self(sample)
        queries = np.arange(len(sample))[:: max(1, len(sample) // 256)]
        seen = []
        for q in queries:
            gap = ((sample - sample[q]) ** 2).sum(1)
            gap[q] = np.inf
            near = np.argsort(gap, kind="stable")[: min(k, len(sample) - 1)]
            seen += DISTANCE[codes[near], codes[q]].sum(1, dtype=int).tolist()
        self.radius = int(np.quantile(seen, quantile, method="higher")) if seen else bits

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.packbits((x - self.mean) @ self.rotation >= 0, axis=1)


class SubstringIndex:
    """For each substring, the rows in the order of its values."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.starts = np.stack([np.concatenate(([0], np.cumsum(np.bincount(c, minlength=256)))) for c in codes.T])

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code lies within the radius."""
        parts = self.codes.shape[1]
        near, more = divmod(radius, parts)
        found = np.zeros(len(self.codes), np.bool_)
        for j in range(parts):
            # radius = parts * near + more: one of the first more + 1 substrings agrees up to near bits, or another up to near - 1.
            values = np.flatnonzero(DISTANCE[code[j]] <= (near if j <= more else near - 1))
            at, counts = self.starts[j][values], self.starts[j][values + 1] - self.starts[j][values]
            begin = np.cumsum(counts) - counts
            found[self.order[:, j][np.repeat(at - begin, counts) + np.arange(counts.sum())]] = True
        rows = np.flatnonzero(found)
        return rows[DISTANCE[self.codes[rows], code].sum(1, dtype=int) <= radius]


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 10, bits: int = 128, sample: int = 4096, quantile: float = 0.99,
    shard_rows: int = 8192, query_rows: int = 2048,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest of ``vectors`` for every row of ``queries``; both from ``usable``."""
    picked = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    if not picked:
        empty = "query_id long, rank int, vec_id long, score double"
        return vectors.sparkSession.createDataFrame([], empty)
    codes = Codes(np.array([r.vector for r in sorted(picked)]), bits, k, quantile)
    n_shards = -(-vectors.count() // shard_rows)
    n_blocks = max(1, -(-queries.count() // query_rows))
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    dealt = lambda n, name: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int").alias(name)
    rows = vectors.select("vec_id", "vector", dealt(n_shards, "shard"), every(n_blocks, "block"))
    asked = queries.select("vec_id", "vector", every(n_shards, "shard"), dealt(n_blocks, "block"))

    def search(own: pa.Table, asked: pa.Table) -> pa.Table:
        ids = own.column("vec_id").to_numpy()
        x = np.stack(own.column("vector").to_numpy()) if len(ids) else np.zeros((0, len(codes.mean)))
        index = SubstringIndex(codes(x)) if len(ids) else None
        out: list[list] = [[], [], []]
        for query, vector in zip(asked.column("vec_id").to_pylist(), asked.column("vector").to_numpy()):
            if index is None:
                break
            code, radius = codes(vector[None, :])[0], codes.radius
            near = index.within(code, radius)
            while (near := near[ids[near] != query]).size < k and radius < bits:
                radius = min(bits, 2 * radius + 8)
                near = index.within(code, radius)
            gap = np.sqrt(((x[near] - vector) ** 2).sum(1))
            best = np.lexsort((ids[near], gap))[:k]
            out[0] += [query] * len(best)
            out[1] += ids[near][best].tolist()
            out[2] += gap[best].tolist()
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    found = rows.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
