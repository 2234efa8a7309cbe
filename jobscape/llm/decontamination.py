"""Benchmark decontamination with spaced seeds.

A seed is the hash of some of the next few words, chosen by a fixed mask; the words at the other places may differ.
Seeds of benchmark items and of documents that agree (a join on the hash, done inside each task against one block of
the benchmark) propose an alignment of a document with an item, without gaps. The alignment is then verified around
the hit: with ``EQUAL`` for an equal word and ``CHANGED`` for a substituted one, the best run of words must hold at least
``LEAST`` equal words (or ``SHORT_SHARE`` of a shorter item). Two equal words outweigh a substituted one, and every 14 words
with substitutions three or more apart hold a seed, so a passage of 17 words is found when every third word at most is replaced
(a lone equal word at either end is left out, so shorter ones may not reach ``LEAST``).

Words are runs of ASCII letters and digits (upper case counts as lower case) and of non-ASCII characters;
punctuation and white space separate them. Whole documents are searched.

The benchmark is cut into blocks of at most about ``block_bytes`` of text, each sent to the tasks for one pass over
the documents; items longer than ``PIECE`` characters are cut into overlapping pieces. A benchmark of any size is so
searched with bounded memory, and documents are never shuffled, so copies and frequent passages meet nowhere.

Items of fewer than ``SEED_WORDS`` words have no seed of their own: they are looked for whole, by the hash of all their
words, and every word must be equal.

Rules: null or empty texts on either side match nothing; items of fewer than ``MIN_WORDS`` words are no evidence and
are left out; repeated items each match, repeated documents each answer; documents without doc_id answer with null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from jobscape.llm.common import chunks, lower_ascii, mixed, spans, text_bytes, tidy, word_hashes

# Places of a seed's words that count (1) and that may differ (0). Fixed values.
MASKS = ("1101011", "11001011", "101100011")
LEAST, SHORT_SHARE, SEED_WORDS, MIN_WORDS = 10, 0.8, 8, 4
# Seeds of whole short items.
WHOLE = tuple("1" * n for n in range(MIN_WORDS, SEED_WORDS))
EQUAL, CHANGED = 10, -19
PIECE, PIECE_OVERLAP = 60_000, 4_000
FILTER_BITS = 22


def _word_bytes() -> np.ndarray:
    inside = np.zeros(256, np.bool_)
    inside[128:] = True
    for a, b in ((48, 58), (65, 91), (97, 123)):
        inside[a:b] = True
    return inside


def _words(column: pa.Array) -> tuple[np.ndarray, ...]:
    data, bounds = text_bytes(column)
    hashes, starts, ends, row = word_hashes(lower_ascii(data), bounds, _word_bytes()[data])
    return hashes, starts - bounds[row], ends - bounds[row], row


def _seeds(hashes: np.ndarray, row: np.ndarray, whole: set[int]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """For each mask, those of ``whole`` lengths too: the hashes of its seeds and where they start. Seeds stay within a row."""
    for k, mask in enumerate(MASKS + WHOLE):
        n = len(hashes) - len(mask) + 1
        if n < 1 or (mask in WHOLE and len(mask) not in whole):
            continue
        total = np.full(n, k + 1, np.uint64)
        for place, care in enumerate(mask):
            if care == "1":
                total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[place : place + n]
        at = np.flatnonzero(row[:n] == row[len(mask) - 1 :])
        yield mask, mixed(total[at]), at


class Index:
    """Seeds of benchmark items, sorted by hash."""

    def __init__(self, texts: list[str]):
        self.hashes, _, _, row = _words(pa.array(texts, pa.string()))
        counts = np.bincount(row, minlength=len(texts))
        self.counts, self.starts = counts, np.cumsum(counts) - counts
        self.whole = {n for n in set(counts.tolist()) if MIN_WORDS <= n < SEED_WORDS}
        found = []
        for mask, h, at in _seeds(self.hashes, row, self.whole):
            use = counts[row[at]] == len(mask) if mask in WHOLE else counts[row[at]] >= SEED_WORDS
            found.append((h[use], at[use]))
        seeds = np.concatenate([h for h, _ in found]) if found else np.zeros(0, np.uint64)
        at = np.concatenate([at for _, at in found]) if found else np.zeros(0, np.int64)
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.at = seeds[order], at[order]
        self.item = row[self.at] if len(self.at) else self.at
        self.maybe = np.zeros(1 << FILTER_BITS, np.bool_)
        self.maybe[self.seeds >> np.uint64(64 - FILTER_BITS)] = True

    def hits(self, hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (item, place of the item's first word in the flat words) proposed by equal seeds."""
        out = []
        for _, seeds, at in _seeds(hashes, row, self.whole):
            near = np.flatnonzero(self.maybe[seeds >> np.uint64(64 - FILTER_BITS)])
            left = np.searchsorted(self.seeds, seeds[near], "left")
            count = np.searchsorted(self.seeds, seeds[near], "right") - left
            run, place = spans(count)
            entry = left[run] + place
            item = self.item[entry]
            out.append(np.stack((row[at[near[run]]], item, at[near[run]] - (self.at[entry] - self.starts[item]))))
        both = np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)
        return np.unique(both, axis=1)

    def verified(self, hashes: np.ndarray, low: int, high: int, item: int, first: int) -> tuple[int, int, int] | None:
        """The best run of an alignment: its first word, the word after it, and how many are equal."""
        begin, end = max(low, first), min(high, first + int(self.counts[item]))
        own = self.hashes[self.starts[item] + begin - first : self.starts[item] + end - first]
        equal = hashes[begin:end] == own
        total = np.cumsum(np.where(equal, EQUAL, CHANGED))
        lowest = np.minimum.accumulate(np.concatenate(([0], total[:-1])))
        last = int(np.argmax(total - lowest))
        start = int(np.argmin(np.concatenate(([0], total[: last + 1]))[: last + 1]))
        matched = int(equal[start : last + 1].sum())
        n = int(self.counts[item])
        if matched >= (n if n < SEED_WORDS else min(LEAST, int(np.ceil(SHORT_SHARE * n)))):
            return begin + start, begin + last + 1, matched
        return None


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, block_bytes: int = 4 << 20, carried: tuple[str, ...] = ()) -> DataFrame:
    """A row for each place where a document repeats an item.

    doc_id, item_id, the bounds of the passage in the UTF-8 text (byte_start, byte_end), ``words`` compared and ``matched``,
    and the ``carried`` columns of the document.
    """
    items = benchmark.filter(F.length("text") > 0).select(
        F.col("item_id").cast("long").alias("item_id"),
        F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / PIECE).cast("int"))).alias("nth"),
        "text",
    ).select("item_id", "nth", F.expr(f"substring(text, nth * {PIECE} + 1, {PIECE + PIECE_OVERLAP})").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-int(size) // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "nth"), F.lit(n_blocks))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), *carried)
    found = None
    for k in range(n_blocks):
        part = sorted((r.item_id if r.item_id is not None else -1, r.nth, r.text) for r in items.filter(block == k).collect())
        own = _search(rows, [i for i, _, _ in part], [t for _, _, t in part], carried)
        found = own if found is None else found.unionByName(own)
    return found


def _search(rows: DataFrame, item_ids: list[int], texts: list[str], carried: tuple[str, ...]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(texts)
        for batch in chunks(batches, "text", 1 << 20):
            hashes, starts, ends, row = _words(batch.column("text"))
            counts = np.bincount(row, minlength=batch.num_rows)
            last = np.cumsum(counts)
            out = []
            for doc, item, first in index.hits(hashes, row).T.tolist():
                best = index.verified(hashes, int(last[doc] - counts[doc]), int(last[doc]), item, first)
                if best:
                    begin, end, matched = best
                    out.append((doc, item_ids[item], int(starts[begin]), int(ends[end - 1]), end - begin, matched))
            if out:
                # Pieces of a long item that overlap find the same passage.
                doc, *rest = zip(*sorted(set(out)))
                of_doc = [batch.column(c).take(pa.array(doc)) for c in ("doc_id", *carried)]
                yield pa.RecordBatch.from_arrays(
                    [of_doc[0], *(pa.array(c, pa.int64()) for c in rest), *of_doc[1:]],
                    names=["doc_id", "item_id", "byte_start", "byte_end", "words", "matched", *carried],
                )

    kinds = "".join(f", `{c}` {rows.schema[c].dataType.simpleString()}" for c in carried)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"doc_id {kind}, item_id long, byte_start long, byte_end long, words long, matched long{kinds}")
