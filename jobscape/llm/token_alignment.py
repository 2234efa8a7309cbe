"""Alignment of two tokenizers by interval coalescing.

Both tokenizers cut the bytes of a blank and the text; every token is an interval of bytes. The intervals of both are
sorted together by their start; a running maximum of the ends shows where a start reaches all that came before, and
there a group begins: the places where a token of either side ends. Inside a group the overlapping pairs of tokens
are expanded from the same order. All of that is done for a batch of texts at once, end to end, in numpy.

How many documents hold a pair of ids linked is counted over the corpus. A task gathers the links of up to ``block``
different (document, pair) entries into one row: the pairs of the block with their document counts, and for each
document the numbers of its pairs and how often each occurs, compressed. Only the pairs of blocks, not those of
documents, are shuffled and summed; the sums go back to their blocks, where they are added up for each document. The
highest count of every id of the first tokenizer is broadcast: its vocabulary bounds the rows.

Rules: the strings of special tokens in a text are plain text; a text that is null or empty, or whose tokens on one
side do not spell the blank and the text, has no tokens: zeros, and an empty ``groups``. Every row counts as a
document of its own, repeated rows and rows without doc_id too. Memory grows with the longest single text. Other
columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from jobscape.llm.common import chunks, spans, text_bytes
from jobscape.llm.words import pattern_tokenizer, piece_tokenizer
from jobscape.sinks.tables import settle

STEP_BYTES = 2 << 20
PAIR = 32  # a pair of ids is the first one shifted by so many bits, and the second


class Spelling:
    """The bytes of every id, and its decimal digits."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.at = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        numbers = [str(i).encode() for i in range(len(tokens))]
        width = len(numbers[-1]) + 1
        self.digits = np.frombuffer(b"".join(n.ljust(width, b"0") for n in numbers), np.uint8).reshape(-1, width)
        self.n_digits = np.fromiter(map(len, numbers), np.int64, len(numbers))

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        return self.flat[np.repeat(self.at[ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]


@lru_cache(2)
def sides(path_a: str, path_b: str) -> tuple:
    a, b = pattern_tokenizer(path_a, True), piece_tokenizer(path_b)
    return a, b, Spelling(a.token_bytes()), Spelling(b.token_bytes())


class Tokens:
    """The tokens of one side: ids, rows, and the bytes they cover; rows that are not spelled right lose theirs."""

    def __init__(self, spelling: Spelling, ids: np.ndarray, counts: np.ndarray, bounds: np.ndarray):
        self.ids, self.sizes = ids, spelling.sizes[ids]
        self.row = np.repeat(np.arange(len(counts)), counts)
        self.spelling = spelling
        self.reach = np.bincount(self.row, self.sizes, len(counts)).astype(np.int64)
        before = np.cumsum(self.reach) - self.reach
        self.start = np.cumsum(self.sizes) - self.sizes + (bounds[:-1] - before)[self.row]

    def right(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Whether each row's tokens spell its bytes."""
        ok = self.reach == np.diff(bounds)
        if not ok.all():
            return ok & np.array([ok[i] and self._equal(data, bounds, i) for i in range(len(ok))], np.bool_)
        same = self.spelling.spelled(self.ids) == data
        if not same.all():
            ok[np.searchsorted(bounds, np.flatnonzero(~same), "right") - 1] = False
        return ok

    def _equal(self, data: np.ndarray, bounds: np.ndarray, i: int) -> bool:
        first, last = np.searchsorted(self.row, (i, i + 1))
        return bool((self.spelling.spelled(self.ids[first:last]) == data[bounds[i] : bounds[i + 1]]).all())

    def keep(self, ok: np.ndarray) -> None:
        if not ok.all():
            there = ok[self.row]
            self.ids, self.sizes, self.row, self.start = (x[there] for x in (self.ids, self.sizes, self.row, self.start))


def coalesced(start_a, end_a, start_b, end_b) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The group of every interval of both sides, and the overlapping pairs (places in a, places in b).

    Each side's intervals follow one another; both sides cover the same bytes.
    """
    n_a, n_b = len(start_a), len(start_b)
    start, end = np.concatenate((start_a, start_b)), np.concatenate((end_a, end_b))
    side = np.concatenate((np.zeros(n_a, np.int8), np.ones(n_b, np.int8)))
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    new = np.ones(len(order), np.bool_)
    new[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    # In this order the b intervals before an a interval start before it; the last of them reaches over its start,
    # unless a group begins there.
    place = np.flatnonzero(side[order] == 0)
    before = place - np.arange(n_a)
    first = before - ~new[place]
    last = np.append(before[1:], n_b) if n_a else before
    of_a, nth = spans(last - first)
    return group[:n_a], group[n_a:], of_a, first[of_a] + nth


def group_texts(a: Tokens, b: Tokens, group_a: np.ndarray, group_b: np.ndarray, rows: int) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` of all rows end to end, and the bounds of the rows."""
    n = len(a.ids) + len(b.ids)
    if not n:
        return b"", np.zeros(rows + 1, np.int64)
    groups = int(group_a[-1]) + 1
    in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    at_a = np.arange(len(a.ids)) + (np.cumsum(in_b) - in_b)[group_a]
    at_b = np.arange(len(b.ids)) + np.cumsum(in_a)[group_b]
    width = max(a.spelling.digits.shape[1], b.spelling.digits.shape[1])
    text = np.zeros((n, width), np.uint8)
    size = np.empty(n, np.int64)
    for side, at in ((a, at_a), (b, at_b)):
        text[at, : side.spelling.digits.shape[1]] = side.spelling.digits[side.ids]
        size[at] = side.spelling.n_digits[side.ids]
    sign = np.full(n, ord(","), np.uint8)
    sign[at_a[np.cumsum(in_a) - 1]] = ord("|")
    sign[at_b[np.cumsum(in_b) - 1]] = ord(";")
    text[np.arange(n), size] = sign
    per_row = np.bincount(a.row, minlength=rows) + np.bincount(b.row, minlength=rows)
    last = np.cumsum(per_row)[per_row > 0] - 1
    size[last] -= 1  # no sign after the last token of a row
    ends = np.append(0, np.cumsum(size + 1))[np.append(0, np.cumsum(per_row))]
    return text[np.arange(width) <= size[:, None]].tobytes(), ends


def aligned(texts: pa.Array, path_a: str, path_b: str) -> tuple[dict[str, np.ndarray], list[bytes], np.ndarray, np.ndarray]:
    """Numbers per row, its groups as text, and the row and pair of ids of every link."""
    side_a, side_b, spell_a, spell_b = sides(path_a, path_b)
    usable = pc.and_(pc.fill_null(pc.greater(pc.binary_length(texts), 0), False), pc.invert(pc.fill_null(pc.match_substring(texts, "▁"), False)))
    # Space marks in a text would come back as blanks: such texts are not spelled right.
    led = pc.if_else(usable, pc.binary_join_element_wise(pa.scalar(" ", texts.type), texts, pa.scalar("", texts.type)), pa.scalar("", texts.type))
    data, bounds = text_bytes(led)
    a = Tokens(spell_a, *side_a(data, bounds), bounds)
    b = Tokens(spell_b, *side_b(data, bounds), bounds)
    ok = a.right(data, bounds) & b.right(data, bounds)
    a.keep(ok)
    b.keep(ok)
    group_a, group_b, of_a, of_b = coalesced(a.start, a.start + a.sizes, b.start, b.start + b.sizes)
    rows = len(texts)
    flat, ends = group_texts(a, b, group_a, group_b, rows)
    at = ends.tolist()
    begins = np.flatnonzero(np.diff(group_a, prepend=-1))
    row = a.row[of_a]
    numbers = {
        "n_a": np.bincount(a.row, minlength=rows), "n_b": np.bincount(b.row, minlength=rows),
        "n_groups": np.bincount(a.row[begins], minlength=rows), "n_links": np.bincount(row, minlength=rows),
    }
    pair = a.ids[of_a].astype(np.int64) << PAIR | b.ids[of_b]
    return numbers, [flat[x:y] for x, y in zip(at, at[1:])], row, pair


def _packed(values: np.ndarray) -> bytes:
    """Numbers below 2 ** 32, byte by byte of each, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


class Block:
    """The documents, pairs and links of some batches."""

    def __init__(self):
        self.rows: list[dict] = []
        self.pairs: list[np.ndarray] = []
        self.codes: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.entries: list[np.ndarray] = []
        self.n = self.known = 0

    def add(self, ids: list, numbers: dict[str, np.ndarray], groups: list[bytes], row: np.ndarray, pair: np.ndarray, whole: bool) -> None:
        coded = pa.array(pair).dictionary_encode()
        own = coded.dictionary.to_numpy()
        entry, times = np.unique(row << PAIR | coded.indices.to_numpy().astype(np.int64), return_counts=True)
        columns = zip(ids, *(numbers[c].tolist() for c in ("n_a", "n_b", "n_groups", "n_links")), groups)
        for doc, n_a, n_b, n_groups, n_links, text in columns:
            shown = text.decode() if whole else hashlib.sha256(text).hexdigest() if n_a else ""
            self.rows.append({"doc_id": doc, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups": shown})
        self.pairs.append(own)
        self.codes.append((entry & (1 << PAIR) - 1) + self.known)
        self.times.append(times)
        self.entries.append(np.bincount(entry >> PAIR, minlength=len(ids)))
        self.known += len(own)
        self.n += len(entry)

    def row(self, number: int) -> dict:
        """The block as one row; its pairs come by falling document count, so that most numbers are small."""
        pairs, of = np.unique(np.concatenate(self.pairs), return_inverse=True)
        code, times = of[np.concatenate(self.codes)], np.concatenate(self.times)
        docs = np.bincount(code, minlength=len(pairs))
        order = np.argsort(-docs, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        entries = np.concatenate(self.entries)
        key = np.repeat(np.arange(len(entries)), entries) << PAIR | rank[code]
        sort = np.argsort(key)
        code = key[sort] & (1 << PAIR) - 1
        step = np.diff(code, prepend=0)
        head = (np.cumsum(entries) - entries)[entries > 0]
        step[head] = code[head]
        return {
            "block": number, "rows": self.rows, "pairs": pairs[order], "docs": docs[order],
            "entries": _packed(entries), "codes": _packed(step), "times": _packed(times[sort]),
        }


ROW = "struct<doc_id: long, n_a: long, n_b: long, n_groups: long, n_links: long, groups: string>"
BLOCK = f"block long, rows array<{ROW}>, pairs array<long>, docs array<long>, entries binary, codes binary, times binary"
_ROW = pa.struct([(c, pa.string() if c == "groups" else pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")])
_BLOCK = pa.schema(
    [("block", pa.int64()), ("rows", pa.list_(_ROW)), ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64()))]
    + [(c, pa.binary()) for c in ("entries", "codes", "times")]
)


def blocks(docs: DataFrame, path_a: str, path_b: str, keep_groups: bool, block: int) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, Block()
        for batch in chunks(batches, "text", STEP_BYTES):
            held.add(batch.column("doc_id").to_pylist(), *aligned(batch.column("text"), path_a, path_b), keep_groups)
            if held.n >= block:
                yield pa.RecordBatch.from_pylist([held.row(number)], _BLOCK)
                number, held = number + 1, Block()
        if held.rows:
            yield pa.RecordBatch.from_pylist([held.row(number)], _BLOCK)

    return rows.mapInArrow(run, BLOCK)


def _summed(held: pa.Table, known: pa.Table) -> pa.Table:
    """The documents of one block with the sums of their links' counts."""
    rows = held.column("rows").combine_chunks()
    (entries, codes, times) = (_unpacked(held.column(c)[0].as_py()) for c in ("entries", "codes", "times"))
    code = known.column("code").to_numpy()
    count, best = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
    count[code] = known.column("n").to_numpy()
    best[code] = known.column("best").to_numpy()
    # Numbers rise within a document, from its first.
    row = np.repeat(np.arange(len(entries)), entries)
    total = np.cumsum(codes)
    head = (np.cumsum(entries) - entries)[entries > 0]
    of = total - np.repeat(total[head] - codes[head], entries[entries > 0])
    sums = [np.append(0, np.cumsum(times * x[of]))[np.append(0, np.cumsum(entries))] for x in (best, count)]
    columns = rows.flatten().flatten()
    return pa.Table.from_arrays(
        [*columns[:5], pa.array(np.diff(sums[0])), pa.array(np.diff(sums[1])), columns[5]],
        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"],
    )


def align(docs: DataFrame, path_a: str, path_b: str, keep_groups: bool = True, block: int = 8_000_000) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups of every document.

    ``path_a`` names a byte-level tokenizer file, ``path_b`` a SentencePiece model. ``groups`` are the ids of each
    group as text, or with ``keep_groups=False`` its SHA-256 (empty without tokens).
    """
    held = settle(blocks(docs, path_a, path_b, keep_groups, block), "aligned")
    pairs = held.select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("code", "found"))
    pairs = pairs.select(F.col("block").alias("of"), "code", F.col("found.pairs").alias("pair"), F.col("found.docs").alias("docs")).repartition("pair")
    tops = pairs.groupBy("pair").agg(F.sum("docs").alias("n")).groupBy(F.shiftright("pair", PAIR).alias("a")).agg(F.max("n").alias("top"))
    counted = pairs.select("of", "code", F.shiftright("pair", PAIR).alias("a"), F.sum("docs").over(Window.partitionBy("pair")).alias("n"))
    known = counted.join(F.broadcast(tops), "a").select("of", "code", "n", (F.col("n") == F.col("top")).cast("long").alias("best"))
    return (
        held.select("block", "rows", "entries", "codes", "times")
        .groupBy("block")
        .cogroup(known.groupBy("of"))
        .applyInArrow(_summed, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
    )
