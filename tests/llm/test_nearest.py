from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobscape.llm import nearest as nn

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(rows, query, k=10):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float32).astype(float)
    gap = np.sqrt(((x - x[ids == query][0]) ** 2).sum(1))
    order = [j for j in np.lexsort((ids, gap)) if ids[j] != query][:k]
    return [(int(ids[j]), float(gap[j])) for j in order]


def run(spark, df, **options):
    vectors = nn.usable(df)
    return nn.nearest(vectors, vectors.filter(F.col("vec_id") % 100 == 0), **options)


def test_index_holds_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 256, (500, 4), np.uint8)
    codes[100:200] = codes[:100] ^ (rng.random((100, 4)) < 0.5).astype(np.uint8)
    index = nn.SubstringIndex(codes)
    for q in codes[:20]:
        distance = nn.DISTANCE[codes, q].sum(1, dtype=int)
        for radius in range(0, 33):
            assert index.within(q, radius).tolist() == np.flatnonzero(distance <= radius).tolist()


@pytest.mark.parametrize("shard_rows", [100_000, 150])
def test_recall_on_the_given_table(spark, shard_rows):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = run(spark, df, shard_rows=shard_rows, query_rows=3).collect()
    found = total = 0
    for q in {r.query_id for r in got}:
        want = exact(rows, q)
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 11))
        found += len({v for v, _ in want} & {r.vec_id for r in own})
        total += len(want)
        scores = dict(want)
        assert all(abs(scores.get(r.vec_id, r.score) - r.score) < 1e-12 for r in own)
    assert found >= 0.9 * total


def test_ties_and_odd_rows(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)] + [(1000, [1.0, 2.0, 3.5])]
    odd = [(400, None), (500, [0.0, 0.0, 0.0]), (600, [1.0, None, 2.0]), (700, [float("nan"), 1.0, 2.0]), (800, [float("inf"), 1.0, 2.0]), (900, [1.0, 2.0]), (None, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(i, v, None) for i, v in rows + odd], SCHEMA).withColumn("shard", F.lit("x")).withColumn("vector", F.lit("x"))
    got = {}
    for r in run(spark, df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {0, 100, 200, 1000}
    assert sorted(got[0]) == [(k, k, 0.0) for k in range(1, 11)]
    assert sorted(got[200]) == [(k + 1, k, 0.0) for k in range(10)]
    assert sorted(got[1000]) == [(k + 1, k, 0.5) for k in range(10)]


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], None), (1, [0.0, 1.0], None)], SCHEMA)
    assert [(r.query_id, r.rank, r.vec_id) for r in run(spark, few).collect()] == [(0, 1, 1)]
    assert run(spark, spark.createDataFrame([], SCHEMA)).count() == 0
