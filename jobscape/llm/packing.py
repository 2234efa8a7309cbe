"""Best-fit packing of documents into sequences, after a reduction by dominance.

Documents become pieces of at most ``capacity`` tokens; only longer ones are cut. Which piece lies where depends on
lengths alone, and there are ``capacity`` of them at most: the number of pieces of each length, a table of bounded
size, is all that the driver sees, however many documents there are.

From it a plan is made. First the reduction of Martello and Toth: a set of up to three lengths that dominates every
other set with its first length can be fixed as a sequence for good, as some best packing holds it. Fixed are a
length and its exact complement, a length beside which nothing fits, one beside which a single piece fits at most
(with the longest that fits), and one beside which two fit at most, when the longest that fits outweighs all pairs or
makes a pair that no other pair outweighs. Each rule goes for as many copies as there are, and the rules are tried
again until none applies. The remainder is packed by best fit, longest first, many equal sequences in one step.

A plan line sends the pieces of one length with ranks from ``first`` on to consecutive sequences. The ranks are found
by Spark: pieces of a length are dealt to slices, numbered inside their slice, and raised by the sizes of the slices
before, so that a length that holds a third of all pieces is no single task.

Rules: a null or empty text holds the end id alone; strings of added tokens are those tokens, as the library has them
by default; rows that repeat a doc_id are documents of their own; rows without doc_id are packed as well. An empty
table gives no pieces. Other columns are not looked at.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from jobscape.llm.common import chunks, spans, text_bytes
from jobscape.llm.words import pattern_tokenizer
from jobscape.sinks.tables import settle

SLICE = 4096


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and (with ``keep_ids``) ids, little-endian uint32, of every piece."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = pattern_tokenizer(tokenizer)
        for batch in chunks(batches, "text"):
            flat, sizes = ids_of(*text_bytes(batch.column("text")))
            flat = np.insert(flat, np.cumsum(sizes), end_id).astype("<u4")
            sizes = sizes + 1
            doc, nth = spans(-(-sizes // capacity))
            length = np.minimum(sizes[doc] - nth * capacity, capacity)
            at = ((np.cumsum(sizes) - sizes)[doc] + nth * capacity).tolist()
            own = [flat[a : a + n].tobytes() for a, n in zip(at, length.tolist())]
            columns = [
                batch.column("doc_id").take(pa.array(doc)), pa.array(nth.astype(np.int32)), pa.array(nth * capacity),
                pa.array(length), pa.array([zlib.crc32(o) for o in own], pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(own, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, kinds)


class Lengths:
    """How many pieces of each length are left."""

    def __init__(self, counts: dict[int, int]):
        self.n = {s: n for s, n in counts.items() if n > 0}
        self.sizes = sorted(self.n)

    def take(self, size: int, times: int = 1) -> None:
        self.n[size] -= times
        if not self.n[size]:
            del self.n[size]
            self.sizes.pop(bisect_left(self.sizes, size))

    def give(self, size: int) -> None:
        if size not in self.n:
            insort(self.sizes, size)
        self.n[size] = self.n.get(size, 0) + 1

    def least(self, k: int, above: int = 0) -> list[int]:
        """The ``k`` smallest lengths above a length, each as often as it is there."""
        out: list[int] = []
        for size in self.sizes[bisect_right(self.sizes, above) :]:
            out += [size] * min(self.n[size], k - len(out))
            if len(out) == k:
                break
        return out

    def fitting(self, room: int) -> int:
        """The largest length that fits, or 0."""
        i = bisect_right(self.sizes, room)
        return self.sizes[i - 1] if i else 0

    def best_pair(self, room: int) -> int:
        """The greatest sum of two pieces that fits."""
        best, low, high = 0, 0, bisect_right(self.sizes, room) - 1
        while low <= high:
            total = self.sizes[low] + self.sizes[high]
            if total > room or (low == high and self.n[self.sizes[low]] < 2):
                high -= 1
            else:
                best = max(best, total)
                low += 1
        return best


def dominating(left: Lengths, size: int, capacity: int) -> tuple[int, ...]:
    """Lengths that some best packing puts into one sequence with a piece of ``size`` (one is taken already); () if unknown."""
    room = capacity - size
    least = left.least(3)
    if not least or least[0] > room:
        return (size,)
    largest = left.fitting(room)
    if largest == room or len(least) == 1 or least[0] + least[1] > room:
        return (size, largest)
    if len(least) == 3 and sum(least) <= room:
        return ()
    if largest >= left.best_pair(room):
        return (size, largest)
    left.take(largest)
    second = left.fitting(room - largest)
    left.give(largest)
    # Any other pair has a piece of at most ``second``, or both above it.
    if second:
        beyond = left.least(2, above=second)
        if len(beyond) < 2 or sum(beyond) > room:
            return (size, largest, second)
    return ()


def reduced(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Sequences fixed by dominance (lengths, how many such sequences), and the lengths that are left."""
    left, fixed, again = Lengths(counts), [], True
    while again:
        again = False
        for size in sorted(left.n, reverse=True):
            while size in left.n:
                left.take(size)
                found = dominating(left, size, capacity)
                left.give(size)
                if not found:
                    break
                times = min(left.n[s] // found.count(s) for s in set(found))
                for s in found:
                    left.take(s, times)
                fixed.append((found, times))
                again = True
    return fixed, left.n


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Sequences of best fit by falling length: the fullest that has room, else a new one."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(held: tuple[int, ...], room: int, times: int) -> None:
        if times:
            if room not in open_:
                insort(rooms, room)
            open_.setdefault(room, []).append((held, times))

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            i = bisect_left(rooms, size)
            if i < len(rooms):
                room = rooms[i]
                held, times = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(i)
            else:
                room, held, times = capacity, (), n
            each = min(room // size, n)
            full = min(times, n // each)
            put(held + (size,) * each, room - each * size, full)
            if held:
                put(held, room, times - full)
            n -= full * each
    return [found for held in open_.values() for found in held]


LINE = "length, first, times, each, sequence, offset"


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Lines of the plan: pieces of ``length`` ranked from ``first`` on go, ``each`` to a sequence, to ``times`` sequences."""
    fixed, rest = reduced(counts, capacity)
    lines, rank, sequence = [], dict.fromkeys(counts, 0), 0
    for held, times in fixed + best_fit(rest, capacity):
        offset = 0
        for size in dict.fromkeys(held):
            each = held.count(size)
            lines.append((size, rank[size], times, each, sequence, offset))
            rank[size] += times * each
            offset += size * each
        sequence += times
    return lines


def ranked(cut: DataFrame, slice_rows: int = SLICE) -> DataFrame:
    """``cut`` with the rank of each piece among those of its length; ``cut`` must be written already."""
    slices = max(1, math.ceil(cut.count() / slice_rows))
    order = [c for c in ("doc_id", "piece", "ids_crc32") if c in cut.columns]
    dealt = cut.withColumn("slice", F.pmod(F.xxhash64(*order), F.lit(slices)))
    sizes = dealt.groupBy("length", "slice").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("length", "slice", F.coalesce(before, F.lit(0)).alias("before"))
    number = F.row_number().over(Window.partitionBy("length", "slice").orderBy(*order))
    numbered = dealt.withColumn("number", number - 1)
    return numbered.join(sizes, ["length", "slice"]).withColumn("rank", F.col("before") + F.col("number")).drop("slice", "before", "number")


def pack(cut: DataFrame, capacity: int = 2048, slice_rows: int = SLICE) -> DataFrame:
    """``cut`` (a table with a length column) with sequence_id and offset of each piece."""
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError(f"pieces must have 1 to {capacity} tokens")
    lines = sorted(plan(counts, capacity))
    length, first, _, each, sequence, offset = np.array(lines, np.int64).reshape(-1, 6).T
    goal = length << 48 | first
    others = cut.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = batch.column("length").to_numpy().astype(np.int64), batch.column("rank").to_numpy()
            line = np.searchsorted(goal, size << 48 | rank, "right") - 1
            step, nth = np.divmod(rank - first[line], each[line])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in others), pa.array(sequence[line] + step), pa.array(offset[line] + nth * size)],
                names=[*others, "sequence_id", "offset"],
            )

    return ranked(cut, slice_rows).select(*others, "rank").mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = True) -> DataFrame:
    """The pieces of all documents and their places."""
    return pack(settle(pieces(docs, tokenizer, capacity, end_id, keep_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens and ids of every sequence, from packed pieces with ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
