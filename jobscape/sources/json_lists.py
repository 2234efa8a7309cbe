"""JSON lists of any size, read in blocks by many tasks.

A byte in the middle of a file does not tell whether it stands inside a string, or how deep. Every block is looked at
twice. First each block says, for both cases (it starts inside a string or outside), how it ends and by how many
levels it rises; these answers are put together from block to block, so that the state at the start of every block
is known. Then each block gives out the objects that start in it, and reads on where the last one ends in a later
block. The driver holds one line per block, as it does for any scan.

For files that are an object with the list under a key, a pass between the two finds the bytes of that list.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 16 << 20
MORE_BYTES = 1 << 20
# Beyond so many blocks a task takes several.
MOST_TASKS = 1024
QUOTE, BACKSLASH = ord("\""), ord("\\")
OPEN, CLOSE = b"{[", b"}]"
BETWEEN = b" \t\r\n,"

ITEMS = "source_file string, block_start bigint, line_in_task bigint, raw_json string"
STATES = "file bigint, start bigint, quotes bigint, outside bigint, inside bigint, first string"
LISTS = "file bigint, start bigint, at bigint, opens boolean"


class Block(InputPartition):
    """Bytes ``start`` to ``end`` of a file, with what is known of its state there."""

    def __init__(self, file: int, path: str, start: int, end: int, size: int, in_string: bool = False, depth: int = 0, lists=None):
        self.file, self.path, self.start, self.end, self.size = file, path, start, end, size
        self.in_string, self.depth, self.lists = in_string, depth, lists


class Blocks(InputPartition):
    """Blocks that follow each other, for one task."""

    def __init__(self, blocks: Sequence[Block]):
        self.blocks = list(blocks)


def _opened(path: str) -> pa.NativeFile:
    if path.startswith("file:/") and not path.startswith("file:///"):
        path = "file://" + path[len("file:") :]
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def _backslashes_before(file: pa.NativeFile, at: int) -> int:
    """How many backslashes stand right before a byte."""
    n = 0
    while at:
        step = min(at, 256)
        tail = file.read_at(step, at - step)
        kept = len(tail.rstrip(b"\\"))
        n += step - kept
        if kept:
            break
        at -= step
    return n


class Structure:
    """Brackets and braces outside strings: their places, steps, and depths after each."""

    def __init__(self, raw: bytes, in_string: bool, depth: int, backslashes: int = 0):
        data = np.frombuffer(raw, np.uint8)
        quotes = np.flatnonzero(data == QUOTE)
        before = np.where(quotes > 0, data[np.maximum(quotes - 1, 0)] == BACKSLASH, backslashes > 0)
        escaped = np.zeros(len(quotes), np.bool_)
        for i in np.flatnonzero(before).tolist():
            at = int(quotes[i])
            run = _run(raw, at)
            escaped[i] = (run + (backslashes if run == at else 0)) % 2
        self.quotes = quotes[~escaped]
        rises = (data == OPEN[0]) | (data == OPEN[1])
        places = np.flatnonzero(rises | (data == CLOSE[0]) | (data == CLOSE[1]))
        within = (np.searchsorted(self.quotes, places) + in_string) % 2 == 1
        self.hidden = places[within]
        self.at = places[~within]
        self.step = np.where(rises[self.at], 1, -1)
        self.depth = depth + np.cumsum(self.step)
        self.kind = data[self.at]
        self.turned = int(np.where(rises[self.hidden], 1, -1).sum()) if len(self.hidden) else 0


def _run(raw: bytes, at: int) -> int:
    start = at
    while start and raw[start - 1] == BACKSLASH:
        start -= 1
    return at - start


def _structure(file: pa.NativeFile, block: Block) -> tuple[bytes, Structure]:
    raw = file.read_at(block.end - block.start, block.start)
    return raw, Structure(raw, block.in_string, block.depth, _backslashes_before(file, block.start))


def _states(block: Block) -> Iterator[tuple]:
    """How the block ends: the number of its quotes, and the levels it rises by if it starts outside or inside a string."""
    with _opened(block.path) as file:
        raw, found = _structure(file, block)
        first = raw.lstrip(b" \t\r\n")[:1].decode("latin-1") if not block.start else ""
        yield block.file, block.start, len(found.quotes), int(found.step.sum()), found.turned, first


def _key_before(file: pa.NativeFile, at: int) -> str | None:
    """The key whose value starts at a byte."""
    reach = 512
    while True:
        head = file.read_at(min(at, reach), max(at - reach, 0)).rstrip(b" \t\r\n")
        if not head.endswith(b":"):
            return None
        head = head[:-1].rstrip(b" \t\r\n")
        end = head.rfind(b'"')
        start = head.rfind(b'"', 0, end)
        while start > 0 and _run(head, start) % 2:
            start = head.rfind(b'"', 0, start)
        if start >= 0:
            return head[start + 1 : end].decode("utf-8", "replace")
        if reach >= at:
            return None
        reach *= 8


def _lists(block: Block, key: str) -> Iterator[tuple]:
    """Where a list under ``key`` of the outer object opens, and where lists on that level close."""
    with _opened(block.path) as file:
        _, found = _structure(file, block)
        for i in np.flatnonzero((found.kind == OPEN[1]) & (found.depth == 2) & (found.step == 1)).tolist():
            at = block.start + int(found.at[i])
            if _key_before(file, at) == key:
                yield block.file, block.start, at, True
        for i in np.flatnonzero((found.kind == CLOSE[1]) & (found.depth == 1)).tolist():
            yield block.file, block.start, block.start + int(found.at[i]), False


def _object_from(file: pa.NativeFile, raw: bytes, start: int, base: int, size: int) -> bytes:
    """The object that starts at a place of a block and ends in a later one."""
    held, at, depth, in_string = [raw[start:]], base + len(raw), 0, False
    found = Structure(held[0], False, 0)
    depth, in_string = int(found.step.sum()), len(found.quotes) % 2 == 1
    while at < size:
        more = file.read_at(min(MORE_BYTES, size - at), at)
        found = Structure(more, in_string, depth, _backslashes_before(file, at))
        ends = np.flatnonzero(found.depth == 0)
        if len(ends):
            return b"".join([*held, more[: int(found.at[ends[0]]) + 1]])
        held.append(more)
        depth += int(found.step.sum())
        in_string ^= len(found.quotes) % 2 == 1
        at += len(more)
    raise ValueError(f"the file ends inside the object at byte {base + start}")


def _items(block: Block, strict: bool) -> Iterator[tuple]:
    """The objects of the list that start in the block. Other items are passed over, or refused with ``strict``."""
    name = block.path.rsplit("/", 1)[-1]
    level = 1 if block.lists is None else 2
    with _opened(block.path) as file:
        raw, found = _structure(file, block)
        here = found.depth == level + 1
        starts = np.flatnonzero(here & (found.step == 1) & (found.kind == OPEN[0]))
        ends = np.flatnonzero((found.depth == level) & (found.step == -1))
        if strict:
            _refuse_others(raw, found, level, block, name)
        number = 0
        for i in starts.tolist():
            at = int(found.at[i])
            if block.lists is not None and not any(a < block.start + at < b for a, b in block.lists):
                continue
            k = int(np.searchsorted(ends, i))
            if k < len(ends):
                own = raw[at : int(found.at[ends[k]]) + 1]
            else:
                own = _object_from(file, raw, at, block.start, block.size)
            yield name, block.start, number, own.decode("utf-8")
            number += 1


def _refuse_others(raw: bytes, found: Structure, level: int, block: Block, name: str) -> None:
    """Items of a list that are no objects: lists, or anything but blanks and commas between the objects."""
    bad = (found.depth == level + 1) & (found.step == 1) & (found.kind != OPEN[0])
    outer = np.flatnonzero((found.depth == level) | ((found.depth == level + 1) & (found.step == 1)) | (found.depth < level))
    edges, depth = [(0, block.depth)], block.depth
    for i in outer.tolist():
        edges.append((int(found.at[i]) + 1, int(found.depth[i])))
    gaps = zip(edges, [int(found.at[i]) for i in outer.tolist()] + [len(raw)])
    other = any(depth == level and raw[a:b].strip(BETWEEN) for (a, depth), b in gaps)
    if bad.any() or other or (block.in_string and block.depth == level):
        raise ValueError(f"{name}: must hold a list of objects")


class JsonBlocks(DataSource):
    """What a pass makes of each block; the pass and its blocks are given."""

    plan: Sequence[Block] = ()
    rows = STATES
    run = None

    @classmethod
    def name(cls):
        return "json_blocks"

    def schema(self):
        return type(self).rows

    def reader(self, schema):
        return BlockReader(type(self).plan, type(self).run)


class BlockReader(DataSourceReader):
    def __init__(self, plan, run):
        self.plan, self.run = plan, run

    def partitions(self):
        each = -(-len(self.plan) // MOST_TASKS)
        return [Blocks(self.plan[at : at + each]) for at in range(0, len(self.plan), each)]

    def read(self, part):
        for block in part.blocks:
            yield from self.run(block)


def _passed(spark: SparkSession, plan: Sequence[Block], rows: str, run) -> DataFrame:
    if not plan:
        return spark.createDataFrame([], rows)
    source = type("JsonBlocksPass", (JsonBlocks,), {"plan": plan, "rows": rows, "run": staticmethod(run)})
    spark.dataSource.register(source)
    return spark.read.format(source.name()).load()


def _planned(spark: SparkSession, path: str, pattern: str | None, block_bytes: int) -> list[Block]:
    reader = spark.read.format("binaryFile")
    reader = reader.option("pathGlobFilter", pattern) if pattern else reader
    files = sorted((r["path"], r["length"]) for r in reader.load(path).select("path", "length").collect())
    return [
        Block(n, name, start, min(start + block_bytes, size), size)
        for n, (name, size) in enumerate(files)
        for start in range(0, max(size, 1), block_bytes)
    ]


def read_json_items(
    spark: SparkSession, path: str, pattern: str | None = None, key: str | None = None, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(source_file, block_start, line_in_task, raw_json): the objects of files that hold a JSON list.

    Without ``key`` a file must be a list of objects; with it a file may also be an object with a list under that
    key, and items that are no objects are passed over. Any other shape fails. The first three columns order the
    objects as they stand in the files; the text of an object is that of the file. Files without a byte hold nothing.
    """
    plan = _planned(spark, path, pattern, block_bytes)
    answers = {(r["file"], r["start"]): r for r in _passed(spark, plan, STATES, _states).collect()}
    wrapped = set()
    in_string, depth = False, 0
    for block in plan:
        answer = answers[block.file, block.start]
        if not block.start:
            in_string, depth = False, 0
            name = block.path.rsplit("/", 1)[-1]
            if answer["first"] == "{" and key is not None:
                wrapped.add(block.file)
            elif answer["first"] != "[":
                raise ValueError(f"{name}: " + (f"expected a list or an object with a list under {key}" if key else "must hold a list of objects"))
        block.in_string, block.depth = in_string, depth
        depth += answer["inside"] if in_string else answer["outside"]
        in_string ^= answer["quotes"] % 2 == 1
    if wrapped:
        _find_lists(spark, plan, wrapped, key)
    read = _items_of(key is None)
    return _passed(spark, plan, ITEMS, read)


def _items_of(strict: bool):
    return lambda block: _items(block, strict)


def _find_lists(spark: SparkSession, plan: Sequence[Block], wrapped: set[int], key: str) -> None:
    """Tells the blocks of wrapped files the bytes of their list."""
    inside = [b for b in plan if b.file in wrapped]
    marks: dict[int, list[tuple[int, bool]]] = {}
    for r in _passed(spark, inside, LISTS, lambda block: _lists(block, key)).collect():
        marks.setdefault(r["file"], []).append((r["at"], r["opens"]))
    for block in inside:
        found = sorted(marks.get(block.file, []))
        opened = [at for at, opens in found if opens]
        if not opened:
            raise ValueError(f"{block.path.rsplit('/', 1)[-1]}: expected a list or an object with a list under {key}")
        block.lists = [(at, min((b for b, opens in found if not opens and b > at), default=block.size)) for at in opened[-1:]]


def parsed_items(items: DataFrame, schema) -> DataFrame:
    """The objects as typed columns; text that does not fit fails the query."""
    rows = items.select(F.from_json("raw_json", schema, {"mode": "FAILFAST"}).alias("r"))
    return rows.select(*[F.col(f"r.`{f.name}`") for f in schema.fields])
