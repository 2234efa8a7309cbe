from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import odd
from jobscape.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def optimum(items, capacity):
    """The fewest sequences, by trying all ways."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for room in set(rooms):
            if room >= items[i]:
                k = rooms.index(room)
                go(i + 1, [*rooms[:k], room - items[i], *rooms[k + 1 :]])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


def instances(n):
    rng = random.Random(1)
    for _ in range(n):
        capacity = rng.choice([10, 17, 30, 100])
        size = lambda: rng.randint(1, capacity) if rng.random() < 0.5 else rng.randint(capacity // 4, capacity // 2 + 1)
        yield capacity, [size() for _ in range(rng.randint(0, 9))]


def test_some_best_packing_holds_what_is_fixed():
    share = 0
    for capacity, items in instances(1500):
        fixed, rest = packing.reduced(Counter(items), capacity)
        assert all(sum(held) <= capacity for held, _ in fixed)
        n = sum(times for _, times in fixed)
        assert n + optimum(Counter(rest).elements(), capacity) == optimum(items, capacity), (capacity, items)
        share += n > 0
    assert share > 1000


def test_best_fit_in_bulk_is_that_of_single_pieces():
    for capacity, items in instances(1500):
        rooms = []
        for item in sorted(items, reverse=True):
            fits = [r for r in rooms if r >= item]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else capacity) - item)
        found = packing.best_fit(Counter(items), capacity)
        assert Counter(r for held, times in found for r in [capacity - sum(held)] * times) == Counter(rooms)


def test_every_rank_has_one_place():
    for capacity, items in instances(500):
        counts, taken = Counter(items), defaultdict(list)
        for length, first, times, each, sequence, offset in packing.plan(counts, capacity):
            for k in range(times * each):
                taken[length].append(first + k)
        assert {s: sorted(r) for s, r in taken.items()} == {s: list(range(n)) for s, n in counts.items()}


def checked(rows, capacity):
    """Sequences are gapless from 0 and not too long."""
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


@pytest.mark.parametrize("capacity", [2048, 16])
def test_pieces_of_odd_rows(spark, library, capacity):
    df = odd.with_clashing(odd.documents(spark)).repartition(4)
    got = packing.packed_documents(df, PATH, capacity)
    rows = got.collect()
    want = []
    for doc, text in ((r.doc_id, r.text) for r in df.collect()):
        ids = library(text)
        for k, at in enumerate(range(0, len(ids), capacity)):
            own = np.array(ids[at : at + capacity], "<u4").tobytes()
            want.append((doc, k, at, len(own) // 4, zlib.crc32(own), own))
    plain = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in rows]
    assert sorted(plain, key=repr) == sorted(want, key=repr)
    assert checked(rows, capacity) >= -(-sum(r.length for r in rows) // capacity)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(got).collect()}
    for r in rows:
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)


def test_no_documents(spark):
    assert packing.packed_documents(odd.nothing(spark), PATH).count() == 0


def test_a_hot_length_over_many_slices(spark):
    cut = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 13 + 1).cast("long").alias("length"))
    rows = packing.pack(cut, 20, slice_rows=64).collect()
    assert len(rows) == 5000 and checked(rows, 20) <= -(-sum(r.length for r in rows) // 20) + 2
    with pytest.raises(ValueError, match="1 to 5 tokens"):
        packing.pack(cut, 5)


def test_query(spark, library):
    from jobscape.llm.queries import QUERIES

    rows = QUERIES["op12_packing"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    want = {}
    for doc, text in texts.items():
        ids = library(text)
        for k, at in enumerate(range(0, len(ids), 2048)):
            own = np.array(ids[at : at + 2048], "<u4").tobytes()
            want[doc, k] = (at, len(own) // 4, zlib.crc32(own))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    least = -(-sum(r.length for r in rows) // 2048)
    assert checked(rows, 2048) <= least + 1
