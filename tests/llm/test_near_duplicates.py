from __future__ import annotations

import collections
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import zstandard

import odd
from jobscape.llm import near_duplicates as nd
from jobscape.llm.components import connected

SCHEMA = "doc_id long, text string"


def sets_of(rows, words):
    out = {}
    for i, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        few = {tuple(found)} if found else set()
        out[i] = {tuple(found[k : k + words]) for k in range(len(found) - words + 1)} if len(found) >= words else few
    return out


def brute(rows, words, percent=80):
    sets, root = sets_of(rows, words), {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    having = collections.defaultdict(list)
    for i, own in sets.items():
        shared = collections.Counter(j for s in own for j in having[s])
        for j, n in shared.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for s in own:
            having[s].append(i)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def result(df, **options):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.near_duplicates(df, **options).collect()}


def copies():
    rng = random.Random(3)
    base = [rng.choice("abcdefgh") + str(rng.randint(0, 300)) for _ in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = str(rng.randint(0, 999))
        rows.append((i, " ".join(words)))
    rows += [(1000, None), (1001, ""), (1002, "x"), (1003, "X"), (1004, " "), (1005, "x y"), (1006, "x y x y x y"), (1007, "x y")]
    return rows + [(2000 + i, "the same text here") for i in range(30)]


# With a small limit the group is a large node: it branches on, and is at last compared in blocks.
@pytest.mark.parametrize(("words", "options"), [(2, {}), (5, {}), (2, {"limit": 16, "levels": 1})])
def test_groups_are_those_of_brute_force(spark, words, options):
    df = spark.createDataFrame(copies(), SCHEMA).repartition(3)
    assert result(df, words=words, **options) == brute(copies(), words)


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert result(df, words=2) == brute([(r.doc_id, r.text) for r in df.collect()], 2)


def test_odd_rows(spark):
    df = odd.with_clashing(odd.documents(spark))
    rows = [(r.doc_id, r.text) for r in df.collect() if r.doc_id is not None]
    got = nd.near_duplicates(df, words=5)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    found = got.collect()
    assert len(found) == df.count()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found if r.doc_id is not None} == brute(rows, 5)
    assert [tuple(r) for r in found if r.doc_id is None] == [(None, None, None, True)] * 2
    assert nd.near_duplicates(odd.nothing(spark)).count() == 0


def test_sketches_and_sizes_lose_no_alike_pair():
    rng = np.random.default_rng(5)
    n = 400
    left = rng.integers(0, 1 << 47, (300, n)).astype(np.uint64)
    right = left.copy()
    right[:, : n // 9] = rng.integers(0, 1 << 47, (300, n // 9)).astype(np.uint64)  # similarity 0.8
    both = np.concatenate((left, right))
    minima = nd._minima(both.reshape(-1), np.full(600, n))
    bits = np.packbits(nd.mixed(minima.astype(np.uint64)) >> np.uint64(63) == 1, axis=1).view(np.int64)
    part = pa.RecordBatch.from_pydict({
        "node": np.tile(np.arange(300), 2), "doc": np.arange(600), "n": np.full(600, n), "s0": bits[:, 0], "s1": bits[:, 1],
    })
    found, _, _ = nd._alike(part.take(np.argsort(part.column("node"), kind="stable")), 80)
    assert len(found) == 300


class Handed:
    """A table whose tasks run here, over these batches."""

    def __init__(self, *batches):
        self.batches = batches

    def mapInArrow(self, run, schema):
        return pa.Table.from_batches(list(run(iter(self.batches))))


def test_a_node_of_near_copies_is_compared_in_little_memory(monkeypatch):
    monkeypatch.setattr(nd, "_by_node", lambda rows: rows)
    rng = np.random.default_rng(4)
    size, few = 2000, 300
    sketch = np.repeat(rng.integers(0, 1 << 62, (2, 2)), (size, few), axis=0)
    for _ in range(6):
        sketch[np.arange(size + few), rng.integers(0, 2, size + few)] ^= 1 << rng.integers(0, 62, size + few)
    doc = rng.permutation(size + few)
    part = pa.RecordBatch.from_pydict({
        "node": np.repeat([1, 2], (size, few)), "doc": doc, "n": np.full(size + few, 400, np.int32), "s0": sketch[:, 0].copy(), "s1": sketch[:, 1].copy(),
    })
    tracemalloc.start()
    found = nd.partners(Handed(part), 80)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # The pairs of the larger node alone are 2 million, of 24 bytes each.
    assert peak < 8 << 20
    assert found.column("doc").to_numpy().tolist() == doc.tolist()
    assert found.column("root").to_numpy().tolist() == [doc[0]] * size + [doc[size]] * few
    for start, end in ((0, size), (size, size + few)):
        own = sketch[start:end]
        apart = sum(np.bitwise_count(own[:, None, k] ^ own[None, :, k]).astype(int) for k in (0, 1))
        np.fill_diagonal(apart, 999)
        assert found.column("apart").to_numpy()[start:end].tolist() == apart.min(axis=1).tolist()
        assert found.column("partner").to_numpy()[start:end].tolist() == doc[start + apart.argmin(axis=1)].tolist()


def test_texts_that_were_packed_small_are_unpacked_a_few_at_a_time():
    texts = [b"a b " * 50_000, b"", b"c"] * 10
    batch = pa.RecordBatch.from_pydict({"doc": list(range(30)), "packed": [zstandard.compress(t) for t in texts]})
    parts = list(nd._unpacked(iter([batch]), 300_000))
    assert max(sum(map(len, t.to_pylist())) for _, t in parts) <= 500_000
    assert [i for doc, _ in parts for i in doc.to_pylist()] == list(range(30))
    assert [t for _, some in parts for t in some.to_pylist()] == texts


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(300, 200), (5, 5)]
    rng.shuffle(edges)
    got = {r.doc: r.component for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}, 200: 200, 300: 200}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0
