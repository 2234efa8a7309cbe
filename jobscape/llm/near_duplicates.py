"""Near duplicates by chosen-path set similarity joins.

A document is its set of word shingles; documents are linked when the sets' Jaccard similarity reaches a threshold,
confirmed on the full sets. Candidates come from independent trees. A node of a tree chooses coordinates of the
minwise signature, one and sometimes a second, ``1 / threshold`` on average, and sends each document to the children
named by its minima there; so a pair at the threshold goes on together through the tree about as often as a critical
branching process survives, ever less the deeper the tree, while unlike documents part at once. The first ``DEPTH``
levels are taken without counting. Then nodes of up to ``limit`` documents are compared exhaustively (sizes, then
128-bit sketches), and larger ones branch on.

A pair at exactly 0.8 misses one tree of three levels with probability 0.36, twelve trees with 4e-6. Where nodes stay
above ``limit`` the trees go deeper and recall falls for pairs close to the threshold: measured misses at exactly 0.8 are
0.05 % after five levels, 0.33 % after seven and 2.7 % after eleven, the deepest. The sketch refuses it with about 3e-6.

Documents with equal sets are one class and take part once. Groups of near copies do not fall apart by branching, so
comparing goes in two steps. First every document is checked against the candidate whose sketch is nearest, which
joins such groups into components. Then the graph of candidates is cut into families (its connected components), and
families that hold several components are compared on full sets: all candidate pairs between different components,
the nearest first, until the components meet. Pairs inside a component need no check, no pair is sent anywhere before
it is confirmed, and no group is expanded into all its pairs.

Node counts are taken on the map side before any document is sent to a node, so no task sees more than ``limit``
documents of one node. Nodes that stay large after ``levels`` more levels are compared in blocks, each block with each
other. Families are compared in blocks of about ``block`` documents; the largest component of a family is not
compared with itself, so a family of one great group and some documents beside it stays linear. Nothing is dropped.
Sets travel only for documents with a candidate. Nothing but counts reaches the driver.

Rules: null texts and texts without words have the empty set, which is linked with nothing; texts with fewer words
than a shingle are one shingle; rows without doc_id stand alone, with null as component; rows that repeat a doc_id
are one document with several texts, and each is answered. Only doc_id and text are looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from jobscape.llm.common import SPACE, chunks, lower_ascii, mixed, packed_texts, text_bytes, tidy, word_hashes
from jobscape.llm.components import connected
from jobscape.sinks.tables import settle

SIGNATURE, BITS = 64, 128
TREES, DEPTH = 12, 3
NODE_SCHEMA = "node long, doc long, n int, s0 long, s1 long"


def shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """48-bit shingle hashes of all rows, distinct and ascending within a row, and the size of each row's set."""
    data, bounds = text_bytes(column)
    hashes, _, _, row = word_hashes(lower_ascii(data), bounds, ~SPACE[data])
    counts = np.bincount(row, minlength=len(column))
    n = len(hashes) - words + 1
    parts, rows = [], []
    if n > 0:
        total = np.zeros(n, np.uint64)
        for k in range(words):
            total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
        inside = row[:n] == row[words - 1 :]
        parts.append(mixed(total[inside]))
        rows.append(row[:n][inside])
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        starts = (np.cumsum(counts) - counts)[short]
        total = np.zeros(len(short), np.uint64)
        for k in range(words - 1):
            more = k < counts[short]
            total[more] = total[more] * np.uint64(0x9E3779B97F4A7C15) + hashes[starts[more] + k]
        parts.append(mixed(total + counts[short].astype(np.uint64)))
        rows.append(short)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(len(column), np.int64)
    key = np.sort(np.concatenate(rows).astype(np.uint64) << np.uint64(48) | np.concatenate(parts) >> np.uint64(16))
    key = key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key
    sizes = np.bincount((key >> np.uint64(48)).astype(np.int64), minlength=len(column))
    return key & np.uint64((1 << 48) - 1), sizes


def _minima(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The BITS minwise values of every non-empty set; one row each."""
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    low = (mixed(values) >> np.uint64(32)).astype(np.uint32)
    random = np.random.default_rng(11).integers(1, 1 << 32, (2, BITS), np.uint32)
    out = np.zeros((len(sizes), BITS), np.uint32)
    if len(starts):
        for k in range(BITS):
            out[sizes > 0, k] = np.minimum.reduceat(low * (random[0, k] | np.uint32(1)) + random[1, k], starts)
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def features(docs: DataFrame, words: int) -> DataFrame:
    """doc, set size, 128-bit name of the set, sketch and signature of every row with a doc_id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text")).filter("doc is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 1 << 20):
            values, sizes = shingle_sets(batch.column("text"), words)
            row = np.repeat(np.arange(len(sizes)), sizes)
            names = []
            for salt in (0, 0x5851F42D4C957F2D):
                total = np.zeros(len(sizes), np.uint64)
                if len(values):
                    total[sizes > 0] = np.add.reduceat(mixed(values ^ np.uint64(salt)), np.flatnonzero(np.diff(row, prepend=-1)))
                names.append(_signed(total))
            minima = _minima(values, sizes)
            bits = np.packbits(mixed(minima.astype(np.uint64)) >> np.uint64(63) == 1, axis=1).view(np.uint64)
            signature = np.ascontiguousarray(minima[:, :SIGNATURE]).view(f"V{4 * SIGNATURE}").reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"), pa.array(sizes, pa.int32()), *names, _signed(bits[:, 0].copy()), _signed(bits[:, 1].copy()),
                    pa.array([v.tobytes() for v in signature], pa.binary()),
                ],
                names=["doc", "n", "k0", "k1", "s0", "s1", "signature"],
            )

    return rows.mapInArrow(tidy(run), "doc long, n int, k0 long, k1 long, s0 long, s1 long, signature binary")


def _children(node: np.ndarray, row: np.ndarray, minima: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The children of (node, row of ``minima``) at the coordinates the nodes choose."""
    choice = mixed(node ^ np.uint64(0xA0761D6478BD642F))
    first = (choice % np.uint64(SIGNATURE)).astype(np.int64)
    second = (choice >> np.uint64(8)) % np.uint64(SIGNATURE)
    twice = np.flatnonzero(choice >> np.uint64(62) == 0)  # one node in four
    node, row = np.concatenate((node, node[twice])), np.concatenate((row, row[twice]))
    at = np.concatenate((first, second[twice].astype(np.int64)))
    return mixed(node + mixed(minima[row, at].astype(np.uint64) << np.uint64(8) | at.astype(np.uint64))), row


def _signatures(column: pa.Array) -> np.ndarray:
    data, _ = text_bytes(column)
    return data.view(np.uint32).reshape(-1, SIGNATURE)


def first_nodes(classes: DataFrame) -> DataFrame:
    """Rows of NODE_SCHEMA: every class in the nodes at level DEPTH of every tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            minima = _signatures(batch.column("signature"))
            for tree in range(TREES):
                row = np.arange(batch.num_rows)
                node = np.full(batch.num_rows, mixed(np.array([tree + 1], np.uint64))[0])
                for _ in range(DEPTH):
                    node, row = _children(node, row, minima)
                yield _node_rows(node, row, batch)

    return classes.select("doc", "n", "s0", "s1", "signature").mapInArrow(tidy(run), NODE_SCHEMA)


def _node_rows(node: np.ndarray, row: np.ndarray, batch: pa.RecordBatch) -> pa.RecordBatch:
    own = batch.select(["doc", "n", "s0", "s1"]).take(pa.array(row))
    return pa.RecordBatch.from_arrays([_signed(node), *own.columns], names=["node", "doc", "n", "s0", "s1"])


def next_nodes(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows one level deeper."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column("node").to_numpy().astype(np.int64).view(np.uint64)
            yield _node_rows(*_children(node, np.arange(batch.num_rows), _signatures(batch.column("signature"))), batch)

    return rows.join(classes.select("doc", "signature"), "doc").select("node", "doc", "n", "s0", "s1", "signature").mapInArrow(tidy(run), NODE_SCHEMA)


class _Nodes:
    """Rows of whole nodes out of batches sorted by node and size."""

    def __init__(self, batches: Iterator[pa.RecordBatch], rows: int = 200_000):
        self.batches, self.rows = batches, rows

    def __iter__(self) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in self.batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= self.rows:
                whole = pa.concat_batches(held)
                node = whole.column("node").to_numpy()
                cut = int(np.searchsorted(node, node[-1], "left"))
                held = [whole.slice(cut)]
                if cut:
                    yield whole.slice(0, cut)
        if held:
            yield pa.concat_batches(held)


def _alike_by_step(
    part: pa.RecordBatch, percent: int, group: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places i before j of the pairs in a node whose sizes and sketches allow the threshold (and groups differ), and
    the bits in which the sketches differ. Pairs equally far apart come together, so a place is once i and once j at most."""
    node, n = part.column("node").to_numpy(), part.column("n").to_numpy().astype(np.int64)
    s0, s1 = (part.column(c).to_numpy().view(np.uint64) for c in ("s0", "s1"))
    p = (1 + percent / 100) / 2
    most = int(BITS * (1 - p) + 4.5 * (BITS * p * (1 - p)) ** 0.5) + 1
    at, step = np.arange(len(node)), 1
    while len(at := at[at + step < len(node)]):
        # Rows of a node ascend by size: past a partner too large for i, all others are.
        at = at[(node[at] == node[at + step]) & (100 * n[at] >= percent * n[at + step])]
        differ = np.bitwise_count(s0[at] ^ s0[at + step]).astype(np.int64) + np.bitwise_count(s1[at] ^ s1[at + step])
        good = differ <= most
        if group is not None:
            good &= group[at] != group[at + step]
        yield at[good], at[good] + step, differ[good]
        step += 1


def _alike(part: pa.RecordBatch, percent: int, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of ``_alike_by_step`` at once: as many as the squares of the nodes' sizes."""
    none = np.zeros(0, np.int64)
    left, right, differ = zip((none, none, none), *_alike_by_step(part, percent, group))
    return np.concatenate(left), np.concatenate(right), np.concatenate(differ)


def _link(root: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Join the groups of the pairs; ``root`` has the least place of each place's group, before and after."""
    while len(apart := np.flatnonzero(root[left] != root[right])):
        left, right = left[apart], right[apart]
        a, b = root[left], root[right]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := root[root], root):
            root[:] = up


def _few_pairs(part: pa.RecordBatch, most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Bounds of runs of whole nodes that have about ``most`` pairs together; a larger node is a run of its own."""
    node = part.column("node").to_numpy()
    bounds = np.concatenate(([0], np.flatnonzero(node[1:] != node[:-1]) + 1, [len(node)]))
    pairs = np.concatenate(([0], np.cumsum(np.diff(bounds) ** 2 // 2)))
    at = 0
    while bounds[at] < len(node):
        end = max(int(np.searchsorted(pairs, pairs[at] + most, "right")) - 1, at + 1)
        yield int(bounds[at]), int(bounds[end])
        at = end


def partners(rows: DataFrame, percent: int) -> DataFrame:
    """Documents with a candidate in their node: the nearest one, ``apart`` bits away, and the ``root`` of their group.

    Groups are the connected parts of the node's candidate pairs, named by one of their documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.iinfo(np.int64).max
        for part in _Nodes(batches):
            nearest, root = np.full(part.num_rows, none), np.arange(part.num_rows)
            # A node of near copies has as many pairs as its square: none is held past its step.
            for left, right, differ in _alike_by_step(part, percent):
                nearest[right] = np.minimum(nearest[right], differ << 32 | left)
                nearest[left] = np.minimum(nearest[left], differ << 32 | right)
                _link(root, left, right)
            live = np.flatnonzero(nearest < none)
            doc = part.column("doc")
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c).take(pa.array(live)) for c in ("doc", "n", "s0", "s1")), pa.array(nearest[live] >> 32, pa.int32()),
                    doc.take(pa.array(nearest[live] & 0xFFFFFFFF)), doc.take(pa.array(root[live])),
                ],
                names=["doc", "n", "s0", "s1", "apart", "partner", "root"],
            )

    return _by_node(rows).mapInArrow(tidy(run), "doc long, n int, s0 long, s1 long, apart int, partner long, root long")


def _by_node(rows: DataFrame) -> DataFrame:
    return rows.repartition("node").sortWithinPartitions("node", "n", "doc")


def _blocks(rows: DataFrame, limit: int) -> DataFrame:
    """Large nodes as pairs of blocks: each becomes a node of about ``limit`` rows."""
    sizes = settle(rows.groupBy("node").agg(F.ceil(2 * F.count("*") / limit).cast("int").alias("blocks")), "large-nodes")
    dealt = rows.join(sizes, "node").withColumn("own", F.pmod(F.xxhash64("doc"), "blocks").cast("int"))
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.withColumn("node", F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other"))).drop("blocks", "own", "other")


def _unpacked(batches: Iterator[pa.RecordBatch], limit: int = 1 << 20) -> Iterator[tuple[pa.Array, pa.Array]]:
    """doc and text of packed rows, about ``limit`` bytes of text at a time, however small they were packed."""
    unpack = zstandard.ZstdDecompressor()
    for batch in chunks(batches, "packed", limit):
        packed, start, texts, held = batch.column("packed"), 0, [], 0
        for k in range(batch.num_rows):
            texts.append(unpack.decompress(packed[k].as_py()))
            held += len(texts[-1])
            if held >= limit or k + 1 == batch.num_rows:
                yield batch.column("doc").slice(start, k + 1 - start), pa.array(texts, pa.binary())
                start, texts, held = k + 1, [], 0


def sets_of(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """doc and ``set`` of the documents in ``ids`` (doc)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, texts in _unpacked(batches):
            values, sizes = shingle_sets(texts, words)
            ends = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([doc, pa.ListArray.from_arrays(ends, _signed(values))], names=["doc", "set"])

    # The ids grow with the documents: they are not broadcast, however few they are.
    wanted = packed_texts(rows).join(ids.hint("merge"), "doc", "left_semi")
    return wanted.mapInArrow(tidy(run), "doc long, set array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that reach the threshold."""
    set_of = lambda end: sets.select(F.col("doc").alias(end), F.col("set").alias(f"set_{end}"))
    both = pairs.join(set_of("b"), "b").join(set_of("a"), "a")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - shared
    return both.filter(100 * shared >= percent * union).select("a", "b")


def family_blocks(members: DataFrame, block: int) -> DataFrame:
    """doc, component and ``node``, a pair of blocks, of the members (doc, component, family) of mixed families.

    The largest component of a family has blocks of its own, which are paired with the other blocks only.
    """
    sizes = members.groupBy("family", "component").agg(F.count("*").alias("n"))
    families = sizes.groupBy("family").agg(
        F.count("*").alias("components"), F.sum("n").alias("members"), F.max(F.struct("n", "component")).alias("main")
    ).filter("components > 1")
    blocks = lambda n: F.ceil(n / block).cast("int")
    families = families.select(
        "family", F.col("main.component").alias("main"), blocks(F.col("main.n")).alias("inner"), blocks(F.col("members") - F.col("main.n")).alias("outer")
    )
    rows = members.join(settle(families, "families"), "family").withColumn("inside", F.col("component") == F.col("main"))
    # Outer blocks come first, then those of the main component.
    own = F.when(F.col("inside"), F.col("outer") + F.pmod(F.xxhash64("doc"), "inner")).otherwise(F.pmod(F.xxhash64("doc"), "outer"))
    others = F.when(F.col("inside"), F.sequence(F.lit(0), F.col("outer") - 1)).otherwise(F.sequence(F.lit(0), F.col("outer") + F.col("inner") - 1))
    rows = rows.withColumn("own", own.cast("int")).withColumn("other", F.explode(others))
    return rows.select("doc", "component", F.xxhash64("family", F.least("own", "other"), F.greatest("own", "other")).alias("node"))


def links_between(rows: DataFrame, percent: int) -> DataFrame:
    """Confirmed pairs (a, b) that join different components in a pair of blocks (NODE_SCHEMA with component and set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _Nodes(batches, rows=1):
            component = part.column("component").to_numpy()
            doc, sets = part.column("doc").to_numpy(), part.column("set")
            bounds, values = sets.offsets.to_numpy(), sets.values.to_numpy()
            parent: dict[int, int] = {}

            def find(x: int) -> int:
                while (up := parent.get(x, x)) != x:
                    parent[x] = parent.get(up, up)
                    x = up
                return x

            out: list[list[int]] = [[], []]
            for start, end in _few_pairs(part):
                left, right, differ = _alike(part.slice(start, end - start), percent, component[start:end])
                for k in np.argsort(differ, kind="stable").tolist():
                    i, j = start + int(left[k]), start + int(right[k])
                    x, y = find(int(component[i])), find(int(component[j]))
                    if x == y:
                        continue
                    a, b = values[bounds[i] : bounds[i + 1]], values[bounds[j] : bounds[j + 1]]
                    shared = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
                    if 100 * shared >= percent * (len(a) + len(b) - shared):
                        parent[max(x, y)] = min(x, y)
                        out[0].append(int(doc[i]))
                        out[1].append(int(doc[j]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["a", "b"])

    return _by_node(rows).mapInArrow(tidy(run), "a long, b long")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, limit: int = 4096, levels: int = 8, block: int = 256
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row; ``percent`` is the least similarity in hundredths."""
    own = settle(features(docs, words), "features")
    classes = settle(
        own.filter("n > 0").groupBy("n", "k0", "k1").agg(F.min("doc").alias("doc"), *(F.first(c).alias(c) for c in ("s0", "s1", "signature"))), "classes"
    )
    rows, live = first_nodes(classes), None
    for level in range(levels + 1):
        large = settle(rows.groupBy("node").count().filter(F.col("count") > limit).select("node"), "large")
        small = partners(rows.join(large, "node", "left_anti"), percent)
        more = not large.isEmpty()
        if more:
            rows = settle(rows.join(large, "node", "left_semi"), "large-rows")
            if level == levels:
                small, more = small.unionByName(partners(_blocks(rows, limit), percent)), False
            else:
                rows = next_nodes(rows, classes)
        small = settle(small, "partners")
        live = small if live is None else live.unionByName(small)
        if not more:
            break
    found = live.groupBy("doc", "n", "s0", "s1").agg(F.min(F.struct("apart", "partner")).alias("to"))
    found = settle(found.select("doc", "n", "s0", "s1", F.col("to.partner").alias("partner")), "nearest-partners")
    sets = settle(sets_of(docs, found.select("doc").distinct(), words), "sets")
    nearest = found.select(F.greatest("doc", "partner").alias("a"), F.least("doc", "partner").alias("b")).distinct()
    links = settle(connected(confirmed(nearest, sets, percent)), "components")

    family = connected(live.select(F.col("doc").alias("a"), F.col("root").alias("b"))).withColumnRenamed("component", "family")
    members = found.select("doc", "n", "s0", "s1").join(family, "doc").join(links, "doc", "left")
    members = settle(members.withColumn("component", F.coalesce("component", "doc")), "members")
    dealt = family_blocks(members.select("doc", "component", "family").distinct(), block)
    dealt = dealt.join(members.select("doc", "n", "s0", "s1"), "doc").join(sets.filter(F.size("set") > 0), "doc")
    more_links = links_between(dealt.select("node", "doc", "n", "s0", "s1", "component", "set"), percent)
    edges = more_links.unionByName(links.select(F.col("doc").alias("a"), F.col("component").alias("b")))
    links = settle(connected(edges), "components")

    of_class = classes.select("n", "k0", "k1", "doc").join(links, "doc", "left")
    of_class = settle(of_class.select("n", "k0", "k1", F.coalesce("component", "doc").alias("component")), "class-components")
    placed = own.join(of_class, ["n", "k0", "k1"], "left").select(
        F.col("doc").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id")
    )
    alone = docs.filter(F.col("doc_id").isNull()).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return placed.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
