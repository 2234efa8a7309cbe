"""Text columns inside Arrow batches, as numpy arrays of bounded size."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

# Bytes of text that one numpy step works on; a single longer row is a step of its own.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` as a task that gives memory back when it ends: the same worker serves stage after stage."""

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return task


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string or binary column and the bounds of its rows; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, bounds, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data else np.zeros(0, np.uint8)
    return flat, bounds - bounds[0]


def chunks(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES, most_rows: int = 1 << 16
) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``limit`` bytes of ``column``, and so many rows; rows stay whole."""
    for batch in batches:
        _, bounds = text_bytes(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(bounds, bounds[start] + limit, "right")) - 1
            end = min(max(end, start + 1), start + most_rows, batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def spans(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of these lengths laid end to end: the run of each element, and its place in the run."""
    run = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.cumsum(lengths) - lengths
    return run, np.arange(len(run)) - starts[run]


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words are runs of bytes where ``inside``; rows end words. Returns hash, start, end and row of each word."""
    edge = np.zeros(len(data) + 1, np.bool_)
    edge[bounds] = True
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate((inside[1:], [False]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    if not len(starts):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    lengths = ends - starts
    word, place = spans(lengths)
    weight = powers(int(lengths.max()) + 1)
    terms = (data[starts[word] + place].astype(np.uint64) + np.uint64(1)) * weight[place]
    sums = np.add.reduceat(terms, np.cumsum(lengths) - lengths)
    row = np.searchsorted(bounds, starts, "right") - 1
    return mixed(sums ^ (lengths.astype(np.uint64) << np.uint64(40))), starts, ends, row


def lower_ascii(data: np.ndarray) -> np.ndarray:
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    return out


# Which bytes separate words: space and the five controls from tab to carriage return.
SPACE = np.zeros(256, np.bool_)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def packed_texts(docs: DataFrame) -> DataFrame:
    """``docs`` with its text compressed, for the way to a join."""
    others = [c for c in docs.columns if c != "text"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(others).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in chunks(batches, "text"):
            texts = [pack.compress(t or b"") for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(texts, pa.binary())], names=[*others, "packed"])

    return docs.select(*others, "text").mapInArrow(tidy(run), f"{kinds}, packed binary")


class _Places(dict):
    """The number of each word; a new word takes the next one and is noted."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.fresh.append(word)
        return n


class WordIds:
    """Token ids of texts whose words are encoded on their own; words met before are remembered.

    ``cut`` cuts a text into words quickly. A word for which ``odd`` holds shows that its text needs ``cut_odd``,
    the slower and general way. ``encode`` gives the ids of words end to end and how many each has. The memory is
    bounded: past ``limit`` words it starts anew.
    """

    def __init__(
        self,
        cut: Callable[[str], list[str]],
        odd: Callable[[str], bool],
        cut_odd: Callable[[str], list[str]],
        encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
        limit: int = 500_000,
    ):
        self.cut, self.odd, self.cut_odd, self.encode, self.limit = cut, odd, cut_odd, encode, limit
        self.forget()

    def forget(self) -> None:
        self.place = _Places()
        self.place.fresh = []
        self.ids = np.zeros(0, np.int32)
        self.sizes = self.starts = np.zeros(0, np.int64)

    def _numbers(self, split: list[list[str]], may_be_odd: bool) -> np.ndarray:
        """The number of every word; words not met before are encoded, odd ones get the size -1."""
        find = self.place.__getitem__
        out = np.fromiter((n for words in split for n in map(find, words)), np.int64)
        if fresh := self.place.fresh:
            odd = np.fromiter(map(self.odd, fresh), np.bool_, len(fresh)) & may_be_odd
            ids, own = self.encode([w for w, o in zip(fresh, odd.tolist()) if not o] if odd.any() else fresh)
            sizes = np.full(len(fresh), -1)
            sizes[~odd] = own
            self.ids = np.concatenate((self.ids, ids))
            self.sizes = np.concatenate((self.sizes, sizes))
            used = np.maximum(self.sizes, 0)
            self.starts = np.cumsum(used) - used
            self.place.fresh = []
        return out

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each text has."""
        if len(self.place) > self.limit:
            self.forget()
        split = [self.cut(t) if t else [] for t in texts]
        of = self._numbers(split, True)
        counts = np.fromiter(map(len, split), np.int64, len(split))
        if (odd := self.sizes[of] < 0).any():
            for i in np.unique(np.repeat(np.arange(len(split)), counts)[odd]).tolist():
                split[i] = self.cut_odd(texts[i])
            of = self._numbers(split, False)
            counts = np.fromiter(map(len, split), np.int64, len(split))
        sizes = self.sizes[of]
        begin = np.cumsum(sizes) - sizes
        flat = self.ids[np.repeat(self.starts[of] - begin, sizes) + np.arange(sizes.sum())] if len(of) else self.ids[:0]
        row = np.repeat(np.arange(len(split)), counts)
        return flat, np.bincount(row, sizes, len(split)).astype(np.int64)
