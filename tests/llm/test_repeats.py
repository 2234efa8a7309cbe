from __future__ import annotations

import hashlib
import random

import pytest

import odd
from jobscape.llm import repeats

SCHEMA = "doc_id long, text string"


def brute(rows):
    """n_bytes, n_removed, n_spans and the hash of what is kept, window by window."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - repeats.WINDOW + 1):
            window = data[at : at + repeats.WINDOW]
            if window in seen:
                gone[at : at + repeats.WINDOW] = b"\1" * repeats.WINDOW
            seen.add(window)
        runs = sum(b and not a for a, b in zip([0, *gone], gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[i] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def result(df, **options):
    return {
        r.doc_id: (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest())
        for r in repeats.remove_repeats(df, **options).collect()
    }


def passages():
    rng = random.Random(5)
    lines = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (60, 99, 100, 101, 130, 400, 70)]
    rows = []
    for i in range(150):
        parts = [rng.choice(lines) if rng.random() < 0.5 else "".join(rng.choice("xyzäé") for _ in range(rng.randint(0, 90))) for _ in range(rng.randint(1, 8))]
        rows.append((i, "".join(parts)))
    return rows + [(900, "a" * 500), (901, "ab" * 300), (902, None), (903, ""), (904, lines[5]), (905, lines[5]), (906, "a" * 99), (907, "a" * 100)]


@pytest.mark.parametrize("limit", [512, 3])
def test_bytes_are_those_of_brute_force(spark, limit):
    df = spark.createDataFrame(passages(), SCHEMA).repartition(3)
    assert result(df, limit=limit) == brute(passages())


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert result(df) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_steps_of_long_texts_lose_no_window(monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(repeats, "STEP_BYTES", 300)
    text = "".join(random.Random(1).choice("abc") for _ in range(2000))
    batch = pa.RecordBatch.from_pydict({"doc": [7], "text": [text]})
    covered = np.zeros(2000, int)
    for _, _, _, place in repeats._chunk_records(batch):
        lo = place >> (2 * repeats.PLACE_BITS)
        for a, b in zip(lo, lo + (place & 127) + 1):
            covered[a:b] += 1
    assert (covered[: 2000 - repeats.WINDOW + 1] == 1).all() and not covered[2000 - repeats.WINDOW + 1 :].any()


def test_maximal_repeats_by_definition():
    rng = random.Random(9)
    for _ in range(60):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(3)]
        want = set()
        for length in range(2, 13):
            places = {}
            for k, t in enumerate(texts):
                for at in range(len(t) - length + 1):
                    places.setdefault(t[at : at + length], []).append((k, at))
            for found in places.values():
                before = {texts[k][at - 1] if at else (k, "start") for k, at in found}
                after = {texts[k][at + length] if at + length < len(texts[k]) else (k, "end") for k, at in found}
                if len(found) > 1 and len(before) > 1 and len(after) > 1:
                    want.add((length, tuple(sorted(found))))
        got = {(length, tuple(sorted(found))) for length, found in repeats.maximal_repeats(texts, 2)}
        assert got == want


def test_odd_rows(spark):
    df = odd.with_clashing(odd.documents(spark))
    rows = {r.doc_id: r.text for r in df.collect() if r.doc_id is not None}
    got = repeats.remove_repeats(df).collect()
    assert len(got) == df.count()
    assert result(df.filter("doc_id is not null")) == brute(rows.items())
    assert all(not r.spans for r in got if r.doc_id is None)
    assert repeats.remove_repeats(odd.nothing(spark)).count() == 0


def test_a_doc_id_with_several_texts_stays_whole(spark):
    text = "".join(map(str, range(100)))
    df = spark.createDataFrame([(1, text), (2, text), (2, text + "x"), (3, text)], SCHEMA)
    got = sorted((r.doc_id, r.n_bytes, len(r.kept)) for r in repeats.remove_repeats(df).collect())
    assert got == [(1, 190, 190), (2, 190, 190), (2, 191, 191), (3, 190, 0)]


def test_whole_characters_and_other_columns_stay(spark):
    text = "é" * 30 + "".join(map(str, range(60)))
    df = spark.createDataFrame([(1, text, 5), (2, "ab" + text[3:] + " end", 6), (3, text, 7), (4, None, 8), (5, "", None)], SCHEMA + ", row int")
    got = {r.doc_id: r for r in repeats.without_repeats(df).collect()}
    assert repeats.without_repeats(df).columns == df.columns
    assert got[1].text == text and got[2].text == "ab end" and got[2].row == 6
    assert 3 not in got and got[4].text is None and got[5].text == ""


@pytest.mark.parametrize("k", [16, 64, 256])
def test_marks_of_nested_surroundings_grow_with_the_rows(k):
    """Every row shares a longer start with the row after it than with the one before."""
    rng = random.Random(k)
    stem = bytes(rng.choice(b"abcdef") for _ in range(101 + k))
    rows = [(doc, 0, stem[: 101 + n] + bytes([200 + doc % 50, doc % 7])) for doc, n in enumerate(rng.sample(range(k), k))]
    marks = repeats.bucket_marks(rows)
    assert len(marks) <= 2 * k
    gone = {doc: bytearray(len(text)) for doc, _, text in rows}
    for doc, start, end in marks:
        gone[doc][start:end] = b"\1" * (end - start)
    seen = set()
    for doc, _, text in sorted(rows):
        want = bytearray(len(text))
        for at in range(len(text) - repeats.WINDOW + 1):
            if text[at : at + repeats.WINDOW] in seen:
                want[at : at + repeats.WINDOW] = b"\1" * repeats.WINDOW
            seen.add(text[at : at + repeats.WINDOW])
        assert gone[doc] == want
