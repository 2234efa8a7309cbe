"""Repeated passages, found in suffix arrays that are cut up by content.

A byte is removed when a string of ``WINDOW`` bytes that covers it also starts earlier (in a document of smaller
doc_id, or earlier in the same one). Strings are judged on the input, and never cross documents.

Every window names an anchor: the leftmost of its ``GRAM``-byte substrings with the smallest hash. Equal windows have
equal anchors, so the suffixes of all documents fall into buckets by anchor, each of them a common-prefix interval
of the corpus' suffix array, and repeats are complete inside buckets. The windows of one anchor are consecutive, so
that one record (anchor, hash of its surroundings, place) stands for about ``(WINDOW - GRAM) / 2`` windows.

- Equal surroundings: all but the first are repeats throughout. Each map task settles its own, so a passage in a
  third of all documents sends a record per task, not per document.
- Buckets with several surroundings get an enhanced suffix array of them. A scan of its common-prefix lengths with a
  stack walks the interval tree; an interval of ``WINDOW`` bytes or more whose members are preceded by different
  bytes is a maximal repeat, with all its occurrences, and all but the earliest are removed. An occurrence is marked
  once, in the innermost such interval that holds an earlier one, so marks grow with the bucket, not with its depth.
- Buckets with more than ``limit`` surroundings (a frequent line among ever different neighbours) are split by the
  whole window instead: occurrences are grouped by its hash, with the first one taken on the map side.

Texts travel twice, compressed, joined by doc_id: to cut out the surroundings of mixed buckets, and to be cut.

Rules: null and empty texts, and those below ``WINDOW`` bytes, lose nothing; rows that repeat a doc_id with the same
text are one document and answered alike; a doc_id that stands for several texts, or none, keeps its texts whole and
takes no part. Hashes have 64 bits and are taken as equal strings in whole surroundings and windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from jobscape.llm.common import chunks, mixed, packed_texts, powers, spans, text_bytes, tidy
from jobscape.sinks.tables import settle

WINDOW, GRAM = 100, 32
SEVERAL = 256  # no byte
BASE = 0x9E3779B97F4A7C15
STEP_BYTES = 1 << 20
TASK_RECORDS = 300_000
# A place: where the windows of an anchor start, how far on the anchor lies, and how far on its last window starts.
PLACE_BITS = 7


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(n, BASE), powers(n, pow(BASE, -1, 1 << 64))


def _prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums whose differences, times a power, hash any substring."""
    up, down = _powers(1 << max(21, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * down[: len(data)], out=sums[1:])
    return sums, up


def _pack(lo: np.ndarray, anchor: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return lo << (2 * PLACE_BITS) | anchor - lo << PLACE_BITS | hi - lo


def _bounds(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that the windows of a place cover."""
    lo = place >> (2 * PLACE_BITS)
    return lo, lo + (place & (1 << PLACE_BITS) - 1) + WINDOW


def records(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor hash, hash of the surroundings, row and place of every anchor."""
    grams = len(data) - GRAM + 1
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(data))
    if grams < 1 or not (left >= WINDOW).any():
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), none, none
    sums, up = _prefix_sums(data)
    hashes = mixed((sums[GRAM:] - sums[:grams]) * up[:grams])
    index = np.uint64((1 << 24) - 1)
    least = hashes & ~index | np.arange(grams, dtype=np.uint64)
    width, whole = 1, WINDOW - GRAM + 1
    while 2 * width <= whole:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < whole:
        least = np.minimum(least[: len(least) - (whole - width)], least[whole - width :])
    start = np.flatnonzero(left[: len(least)] >= WINDOW)
    anchor = (least[start] & index).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    lo, hi = start[first], start[np.append(first[1:], len(start)) - 1]
    anchor = anchor[first]
    around = (sums[hi + WINDOW] - sums[lo]) * up[lo]
    shape = (anchor - lo << 8 | hi - lo).astype(np.uint64)
    row = np.searchsorted(bounds, lo, "right") - 1
    base = bounds[row]
    return hashes[anchor], mixed(mixed(around) + shape), row, _pack(lo - base, anchor - base, hi - base)


def _chunk_records(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    data, bounds = text_bytes(batch.column("text"))
    doc = batch.column("doc").to_numpy()
    if len(data) <= 2 * STEP_BYTES:
        gram, around, row, place = records(data, bounds)
        yield gram, around, doc[row], place
        return
    # One very long text: its windows in steps.
    for at in range(0, len(data), STEP_BYTES):
        piece = data[at : at + STEP_BYTES + WINDOW - 1]
        gram, around, row, place = records(piece, np.array([0, len(piece)]))
        yield gram, around, doc[row], place + (at << (2 * PLACE_BITS))


def _firsts(gram, around, doc, place) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order, which rows are first of their surroundings in it, and which repeat an earlier place."""
    order = np.lexsort((place, doc, around, gram))
    gram, around, doc, place = gram[order], around[order], doc[order], place[order]
    first = np.ones(len(order), np.bool_)
    first[1:] = (gram[1:] != gram[:-1]) | (around[1:] != around[:-1])
    head = np.flatnonzero(first)[np.cumsum(first) - 1]
    return order, first, (doc != doc[head]) | (place != place[head])


RECORD = "gram long, around long, doc long, place long"


def anchors(docs: DataFrame) -> DataFrame:
    """Records of all documents, the first of each task; and the places this task alone knows to repeat (gram null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in chunks(batches, "text", STEP_BYTES):
            held += _chunk_records(batch)
            if sum(len(h[0]) for h in held) >= TASK_RECORDS:
                yield _settled(held)
                held = []
        if held:
            yield _settled(held)

    return docs.mapInArrow(tidy(run), RECORD)


def _settled(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*held)]
    order, first, repeats = _firsts(*columns)
    keep = first | repeats
    gram, around, doc, place = (c[order][keep] for c in columns)
    mask = repeats[keep]
    return pa.RecordBatch.from_arrays(
        [pa.array(gram.view(np.int64), mask=mask), pa.array(around.view(np.int64), mask=mask), pa.array(doc), pa.array(place)],
        names=["gram", "around", "doc", "place"],
    )


def sorted_out(rows: DataFrame) -> DataFrame:
    """Places that repeat (gram null), and the first of each surroundings in buckets that have several.

    Rows come in the order of gram, surroundings, document and place; what is known of the bucket at the end of a
    batch goes on to the next, so a bucket of any size passes through.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # gram, surroundings, document and place of the last first row; whether it was given out
        for batch in batches:
            known = batch.filter(batch.column("gram").is_valid())
            ready = batch.filter(batch.column("gram").is_null()).select(["gram", "doc", "place"])
            if ready.num_rows:
                yield ready
            if not known.num_rows:
                continue
            gram, around, doc, place = (known.column(c).to_numpy() for c in ("gram", "around", "doc", "place"))
            carried = 0 if last is None else 1
            if carried:
                gram, around, doc, place = (np.concatenate(([v], x)) for v, x in zip(last, (gram, around, doc, place)))
            new = np.ones(len(gram), np.bool_)
            new[1:] = gram[1:] != gram[:-1]
            first = new.copy()
            first[1:] |= around[1:] != around[:-1]
            head = np.flatnonzero(first)[np.cumsum(first) - 1]
            repeats = (doc != doc[head]) | (place != place[head])
            heads = np.flatnonzero(first)
            bucket = np.cumsum(new)[heads]
            beside = np.zeros(len(heads), np.bool_)
            beside[1:] = bucket[1:] == bucket[:-1]
            beside[:-1] |= bucket[:-1] == bucket[1:]
            give = heads[beside]
            if carried:
                give = give[(give > 0) | (not last[4])]  # the carried row goes out once
            out = np.concatenate((np.flatnonzero(repeats), give))
            if len(out):
                mask = np.arange(len(out)) < repeats.sum()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram[out], mask=mask), pa.array(doc[out]), pa.array(place[out])], names=["gram", "doc", "place"]
                )
            h = heads[-1]
            last = (gram[h], around[h], doc[h], place[h], bool(beside[-1]) or bool(carried and h == 0 and last[4]))

    ordered = rows.repartition(F.coalesce("gram", F.xxhash64("doc"))).sortWithinPartitions("gram", "around", "doc", "place")
    return ordered.mapInArrow(tidy(run), "gram long, doc long, place long")


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low = 0
    while n - low > 1:
        mid = (low + n) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            n = mid
    return low


def intervals(texts: list[bytes], least: int) -> tuple[list[tuple[int, int]], Iterator[tuple[int, int, int]]]:
    """The suffix array (text, start) of repeated starts, and its intervals: length, first and end, inner ones first.

    Only intervals whose members are preceded by different bytes or starts are given: the others are parts of a longer
    repeat that begins further left. The suffixes are sorted, and a stack closes the intervals of their common-prefix
    lengths.
    """
    # A suffix whose start is unlike all others lies in no interval; hashes tell well enough which ones to leave out.
    places = [(k, at) for k, text in enumerate(texts) for at in range(len(text) - least + 1)]
    starts = np.fromiter((hash(texts[k][at : at + least]) for k, at in places), np.int64, len(places))
    order = np.argsort(starts, kind="stable")
    same = starts[order][1:] == starts[order][:-1]
    shared = np.concatenate(([False], same)) | np.concatenate((same, [False])) if len(places) else same
    array = sorted((texts[k][at:], k, at) for k, at in (places[i] for i in order[shared].tolist()))

    def scan() -> Iterator[tuple[int, int, int]]:
        stack: list[list] = []  # length, first suffix, byte before the suffixes (SEVERAL when they differ)
        for i in range(1, len(array) + 1):
            shared = _common(array[i - 1][0], array[i][0]) if i < len(array) else 0
            _, k, at = array[i - 1]
            left, before = i - 1, texts[k][at - 1] if at else ~k  # a start is like no byte and no other start
            while stack and stack[-1][0] > shared:
                length, left, seen = stack.pop()
                before = before if before == seen else SEVERAL
                if before == SEVERAL:
                    yield length, left, i
            if shared >= least:
                if stack and stack[-1][0] == shared:
                    stack[-1][2] = before if before == stack[-1][2] else SEVERAL
                else:
                    stack.append([shared, left, before])

    return [(k, at) for _, k, at in array], scan()


def maximal_repeats(texts: list[bytes], least: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """Length and all occurrences (text, start) of every maximal repeat of at least ``least`` bytes.

    A repeat is maximal when its occurrences are followed by different bytes or ends, and preceded by different bytes
    or starts.
    """
    array, found = intervals(texts, least)
    for length, first, end in found:
        yield length, array[first:end]


def bucket_marks(rows: list[tuple[int, int, bytes]]) -> list[tuple[int, int, int]]:
    """(doc, start, end) of what repeats in a bucket, from (doc, place, surroundings); overlapping runs of a row are joined.

    An occurrence is marked once, with the longest maximal repeat in which it is not the earliest: in the inner
    interval all members but the earliest are marked and leave, the earliest goes on to the interval around. So there
    are no more marks than occurrences, however deep the intervals lie.
    """
    rows = sorted(rows)
    array, found = intervals([text for _, _, text in rows], WINDOW)
    base = [place >> (2 * PLACE_BITS) for _, place, _ in rows]
    at = [(rows[k][0], base[k] + start) for k, start in array]
    there, ahead = [True] * len(array), list(range(1, len(array) + 1))  # who has not left, and where the next may be
    marks: dict[int, list[tuple[int, int]]] = {}
    for length, first, end in found:
        members, i = [], first
        while i < end:
            if there[i]:
                members.append(i)
            i = ahead[i]
        stays = min(members, key=at.__getitem__)
        for i in members:
            there[i] = i == stays
            if at[i] != at[stays]:
                marks.setdefault(array[i][0], []).append((at[i][1], at[i][1] + length))
        if stays > first:
            ahead[first] = stays
        ahead[stays] = end
    return [(rows[k][0], a, b) for k, runs in marks.items() for a, b in merged(runs)]


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, bytes]]]:
    gram, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("gram", "doc", "place", "around"))):
            if row[0] != gram and held:
                yield held
                held = []
            gram = row[0]
            held.append(row[1:])
    if held:
        yield held


MARK = "doc long, start long, end long"


def _marks(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc", "start", "end"])


def small_bucket_marks(contexts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for bucket in _buckets(batches):
            out += bucket_marks(bucket)
            if len(out) > 50_000:
                yield _marks(out)
                out = []
        yield _marks(out)

    return contexts.repartition("gram").sortWithinPartitions("gram").mapInArrow(tidy(run), MARK)


def large_bucket_marks(contexts: DataFrame) -> DataFrame:
    """Windows of large buckets, grouped by their own hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "around", 1 << 18):
            data, bounds = text_bytes(batch.column("around"))
            sums, up = _prefix_sums(data)
            row, nth = spans(np.diff(bounds) - WINDOW + 1)
            at = bounds[row] + nth
            lo = (batch.column("place").to_numpy() >> (2 * PLACE_BITS))[row] + nth
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(mixed((sums[at + WINDOW] - sums[at]) * up[at]).view(np.int64)),
                    pa.array(batch.column("doc").to_numpy()[row]), pa.array(lo),
                ],
                names=["window", "doc", "start"],
            )

    windows = settle(contexts.select("doc", "place", "around").mapInArrow(tidy(run), "window long, doc long, start long"), "windows")
    firsts = windows.groupBy("window").agg(F.min(F.struct("doc", "start")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = windows.join(settle(firsts.drop("n"), "first-windows"), "window").filter(F.struct("doc", "start") != F.col("first"))
    return later.select("doc", "start", (F.col("start") + WINDOW).alias("end"))


def _joined(marks: DataFrame) -> DataFrame:
    """Overlapping marks of a document joined, batch by batch, so that few are gathered afterwards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            doc, start, end = (batch.column(c).to_numpy() for c in ("doc", "start", "end"))
            new = np.concatenate(([True], doc[1:] != doc[:-1]))
            # Ends rise over all rows once each document is set off from the one before.
            shift = (np.cumsum(new) - 1) * (int(end.max()) + 1)
            reach = np.maximum.accumulate(end + shift)
            head = np.flatnonzero(np.concatenate(([True], (start + shift)[1:] > reach[:-1])) | new)
            last = np.append(head[1:], len(doc)) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[head]), pa.array(start[head]), pa.array(reach[last] - shift[last])], names=["doc", "start", "end"]
            )

    return marks.repartition("doc").sortWithinPartitions("doc", "start").mapInArrow(tidy(run), MARK)


def _contexts(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """gram, doc, place and surroundings of the wanted records."""
    lists = wanted.groupBy("doc").agg(F.collect_list(F.struct("gram", "place")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in chunks(batches, "packed", 1 << 20):
            out: list[list] = [[], [], [], []]
            for doc, packed, records in zip(*(batch.column(c).to_pylist() for c in ("doc", "packed", "wanted"))):
                text = unpack.decompress(packed)
                for r in records:
                    lo = r["place"] >> (2 * PLACE_BITS)
                    out[0].append(r["gram"])
                    out[1].append(doc)
                    out[2].append(r["place"])
                    out[3].append(text[lo : lo + (r["place"] & (1 << PLACE_BITS) - 1) + WINDOW])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["gram", "doc", "place", "around"])

    joined = packed_texts(docs).join(lists, "doc").select("doc", "packed", "wanted")
    return joined.mapInArrow(tidy(run), "gram long, doc long, place long, around binary")


def repeated_marks(docs: DataFrame, limit: int = 4096) -> DataFrame:
    """(doc, start, end): every byte to remove lies in one; from ``docs`` with doc and text."""
    found = settle(sorted_out(anchors(docs)), "repeats")
    wanted = found.filter("gram is not null")
    large = settle(wanted.groupBy("gram").count().filter(F.col("count") > limit).select("gram"), "large-buckets")
    contexts = settle(_contexts(wanted, docs), "surroundings")
    lo = F.shiftright("place", 2 * PLACE_BITS)
    known = found.filter("gram is null").select(
        "doc", lo.alias("start"), (lo + F.col("place").bitwiseAND((1 << PLACE_BITS) - 1) + WINDOW).alias("end")
    )
    marks = known.unionByName(small_bucket_marks(contexts.join(large, "gram", "left_anti")))
    if not large.isEmpty():
        marks = marks.unionByName(large_bucket_marks(contexts.join(large, "gram", "left_semi")))
    return marks


def _cut(docs: DataFrame, limit: int, whole_characters: bool) -> DataFrame:
    """``docs`` (doc, text and others) without text, with n_bytes, spans and kept."""
    named = docs.select("doc", "text")
    texts = named.groupBy("doc").agg(F.min(F.xxhash64("text")).alias("x"), F.max(F.xxhash64("text")).alias("y"))
    unclear = settle(texts.filter("x <> y or doc is null").select("doc"), "unclear")
    clear = named.filter("doc is not null")
    if not unclear.isEmpty():
        clear = clear.join(unclear, "doc", "left_anti")
    marks = _joined(repeated_marks(clear, limit))
    lists = marks.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("marks"))
    others = [c for c in docs.columns if c != "text"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(others).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in chunks(batches, "packed", 1 << 20):
            sizes, kept, cut = [], [], []
            for packed, marks in zip(batch.column("packed").to_pylist(), batch.column("marks").to_pylist()):
                text = unpack.decompress(packed)
                runs = merged((m["start"], m["end"]) for m in marks or ())
                if whole_characters:
                    runs = [run for run in (_whole(text, a, b) for a, b in runs) if run[0] < run[1]]
                at = [0, *(x for run in runs for x in run), len(text)]
                sizes.append(len(text))
                kept.append(b"".join(text[a:b] for a, b in zip(at[::2], at[1::2])))
                cut.append([{"start": a, "end": b} for a, b in runs])
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in others), pa.array(sizes, pa.int64()), pa.array(cut, span), pa.array(kept, pa.binary())],
                names=[*others, "n_bytes", "spans", "kept"],
            )

    joined = packed_texts(docs).join(lists, "doc", "left").select(*others, "packed", "marks")
    return joined.mapInArrow(tidy(run), f"{kinds}, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def _whole(text: bytes, a: int, b: int) -> tuple[int, int]:
    """The run without the characters that it holds in part only."""
    while a < b and text[a] & 0xC0 == 0x80:
        a += 1
    while a < b < len(text) and text[b] & 0xC0 == 0x80:
        b -= 1
    return a, b


def remove_repeats(docs: DataFrame, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, spans (start, end of the maximal removed runs) and kept (the other bytes) of every row."""
    return _cut(_keyed(docs), limit, False).withColumnRenamed("doc", "doc_id")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))


def without_repeats(docs: DataFrame, limit: int = 4096) -> DataFrame:
    """The rows of ``docs`` with the text that is left; characters that repeat only in part stay.

    Rows whose text held something and has nothing left are left out.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    rows = rows.select(
        F.col("row.doc_id").cast("long").alias("doc"), F.col("row.text").cast("string").alias("text"),
        F.col("row").dropFields("text").alias("row"), F.col("row.text").isNull().alias("empty"),
    )
    left = _cut(rows, limit, True).filter("n_bytes = 0 or octet_length(kept) > 0")
    text = F.when(~F.col("empty"), F.col("kept").cast("string"))
    return left.select(*(text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def merged(runs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching runs joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out
