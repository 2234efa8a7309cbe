"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text becomes its escaped form (a space mark before it and in place of each space), cut where no vocabulary piece
can reach across: before a space mark that follows another character, and around line ends. The distinct words of
a chunk lie in one flat array of symbol numbers. In each round every word finds, by a segmented minimum, the best
rank among its neighbouring pairs, all words merge at once, and the array is compacted; a word leaves when no pair
of it is a piece. Results equal the library's, which merges the best pair of a text, the leftmost first: a word merges all its
best pairs in one round only when none of the pairs this makes ranks as high, and the leftmost alone otherwise.

The model file is read through the ``sentencepiece`` package (pieces, scores, kinds); encoding and decoding are
done here. Rules: a null or empty text has no ids and decodes to the empty text; characters outside the vocabulary
become byte pieces (or the unknown piece, where the model has no byte pieces); control pieces decode to nothing.
Repeated rows are answered alike; only the key and text columns are looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from jobscape.llm.common import WordIds, chunks, tidy

MARK = "▁"
SHIFT = 21  # a code point or a piece number plus the vocabulary size fits in so many bits
SPREAD = 0x9E3779B97F4A7C15
NONE = 1 << 40  # the rank of a pair that is no piece


class Pieces:
    """A BPE model as sorted pair tables."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = n = model.vocab_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(n)]
        self.texts = [model.id_to_piece(i) for i in range(n)]
        self.byte_ids = np.full(256, model.unk_id(), np.int64)
        for i in range(n):
            if model.is_byte(i):
                self.byte_ids[int(self.texts[i][3:5], 16)] = i
        self.has_bytes = any(model.is_byte(i) for i in range(n))
        self.unknown = model.unk_id()
        known = {self.texts[i]: i for i in range(n) if not special[i] and not model.is_unused(i)}
        self.splits = all(MARK not in p.lstrip(MARK) and "\n" not in p for p in known)
        self.first = np.arange(0x110000, dtype=np.int64) + n
        for p, i in known.items():
            if len(p) == 1:
                self.first[ord(p)] = i
        scores = {i: model.get_score(i) for i in known.values()}
        ranks = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        number = lambda s: known[s] if s in known else n + ord(s) if len(s) == 1 else -1
        pairs = {}
        for p, i in known.items():
            for cut in range(1, len(p)):
                left, right = number(p[:cut]), number(p[cut:])
                if left >= 0 and right >= 0:
                    pairs[left << SHIFT | right] = (i, ranks[scores[i]])
        self._hash(pairs)
        surface = [
            bytes([int(t[3:5], 16)]) if model.is_byte(i) else " ⁇ ".encode() if model.is_unknown(i)
            else b"" if model.is_control(i) else t.replace(MARK, " ").encode()
            for i, t in enumerate(self.texts)
        ]
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_len = np.fromiter(map(len, surface), np.int64, n)
        self.surface_at = np.cumsum(self.surface_len) - self.surface_len
        self.starts_blank = np.fromiter((t.startswith(MARK) and not s for t, s in zip(self.texts, special)), np.bool_, n)

    def _hash(self, pairs: dict[int, tuple[int, int]]) -> None:
        """Pairs in open addressing: the slot of a key, or one of the slots after it."""
        self.bits = max(4, (len(pairs) * 8).bit_length())
        self.keys = np.full((1 << self.bits) + 64, -1, np.int64)
        self.merged = np.zeros(len(self.keys), np.int64)
        self.rank = np.full(len(self.keys), NONE)
        for key, (piece, rank) in sorted(pairs.items()):
            at = ((key * SPREAD) & (1 << 64) - 1) >> (64 - self.bits)
            while self.keys[at] >= 0:
                at += 1
            self.keys[at], self.merged[at], self.rank[at] = key, piece, rank

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece and rank of pairs of symbols; rank ``NONE`` where they make no piece."""
        key = left << SHIFT | right
        at = ((key.astype(np.uint64) * np.uint64(SPREAD)) >> np.uint64(64 - self.bits)).astype(np.int64)
        found = self.keys[at]
        more = np.flatnonzero((found != key) & (found >= 0))
        while len(more):
            at[more] += 1
            found = self.keys[at[more]]
            more = more[(found != key[more]) & (found >= 0)]
        return self.merged[at], np.where(self.keys[at] == key, self.rank[at], NONE)

    def words(self, text: str) -> list[str]:
        """The escaped text cut where no piece reaches across."""
        text = MARK + text.replace(" ", MARK)
        return re.findall(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n", text) if self.splits else [text]

    def merge(self, words: list[str], step: int = 6_000) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and how many each word has; ``step`` words fit the processor's cache."""
        parts = [self._merge(words[i : i + step]) for i in range(0, len(words), step)]
        if not parts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        return np.concatenate([ids for ids, _ in parts]), np.concatenate([sizes for _, sizes in parts])

    def _merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.first[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        word = np.repeat(np.arange(len(words)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        piece, rank = self.lookup(symbols, np.append(symbols[1:], 0))
        rank[np.flatnonzero(np.append(word[1:] != word[:-1], True))] = NONE
        while len(symbols):
            start = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            size = np.diff(np.append(start, len(symbols)))
            best = np.minimum.reduceat(rank, start)
            over = best == NONE
            if over.any():
                leave = np.repeat(over, size)
                done.append((word[leave], symbols[leave]))
                symbols, word, piece, rank = (x[~leave] for x in (symbols, word, piece, rank))
                if not len(symbols):
                    break
                best, size = best[~over], size[~over]
            nth = np.repeat(np.arange(len(size)), size)
            # In a chain of overlapping pairs the first, third, fifth ... are merged.
            where = np.flatnonzero(rank == best[nth])
            chain = np.concatenate(([True], np.diff(where) > 1))
            head = np.maximum.accumulate(np.where(chain, where, 0))
            where = where[(where - head) % 2 == 0]
            own, new = nth[where], piece[where]
            # A merge is safe beside others when the pairs it makes rank behind it.
            left = symbols[where - 1]
            beside = np.concatenate(([False], np.diff(where) == 2))
            left[beside] = new[np.flatnonzero(beside) - 1]
            has_left = (where > 0) & (nth[where - 1] == own)
            after = np.minimum(where + 2, len(symbols) - 1)
            has_right = (where + 2 < len(symbols)) & (nth[after] == own)
            least = np.minimum(
                np.where(has_left, self.lookup(left, new)[1], NONE),
                np.where(has_right, self.lookup(new, symbols[after])[1], NONE),
            )
            unsafe = np.zeros(len(size), np.bool_)
            unsafe[own[least <= best[own]]] = True
            leftmost = np.concatenate(([True], own[1:] != own[:-1]))
            take = where[leftmost | ~unsafe[own]]
            symbols[take] = piece[take]
            keep = np.ones(len(symbols), np.bool_)
            keep[take + 1] = False
            symbols, word, piece, rank = (x[keep] for x in (symbols, word, piece, rank))
            # Only pairs beside a merged symbol are new.
            now = take - np.arange(len(take))
            now = np.unique(np.concatenate((now, now[now > 0] - 1)))
            follow = np.minimum(now + 1, len(symbols) - 1)
            piece[now], fresh = self.lookup(symbols[now], symbols[follow])
            rank[now] = np.where((follow > now) & (word[follow] == word[now]), fresh, NONE)
        word = np.concatenate([w for w, _ in done]) if done else np.zeros(0, np.int64)
        symbols = np.concatenate([s for _, s in done]) if done else np.zeros(0, np.int64)
        order = np.argsort(word, kind="stable")
        return self._spelled(symbols[order], word[order], len(words))

    def _spelled(self, symbols: np.ndarray, word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Characters outside the vocabulary replaced by byte pieces."""
        foreign = np.flatnonzero(symbols >= self.size)
        if len(foreign):
            spelled = [
                self.byte_ids[list(chr(c).encode())] if self.has_bytes else np.array([self.unknown])
                for c in (symbols[foreign] - self.size).tolist()
            ]
            lengths = np.ones(len(symbols), np.int64)
            lengths[foreign] = [len(s) for s in spelled]
            out = np.repeat(symbols, lengths)
            out[np.repeat(symbols >= self.size, lengths)] = np.concatenate(spelled)
            symbols, word = out, np.repeat(word, lengths)
        return symbols.astype(np.int32), np.bincount(word, minlength=n)

    def surfaces(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of the decoded rows, end to end, and the length of each."""
        lengths = self.surface_len[ids]
        at = self.surface_at[ids]
        first, end = (np.cumsum(sizes) - sizes)[sizes > 0], np.cumsum(sizes)[sizes > 0]
        # The mark before a text is no blank; control pieces do not count as a beginning.
        while (past := (lengths[first] == 0) & (first + 1 < end)).any():
            first = first + past
        blank = first[self.starts_blank[ids[first]]]
        at[blank] += 1
        lengths[blank] -= 1
        begin = np.cumsum(lengths) - lengths
        flat = self.surface[np.repeat(at - begin, lengths) + np.arange(lengths.sum())]
        row = np.repeat(np.arange(len(sizes)), sizes)
        return flat, np.bincount(row, lengths, len(sizes)).astype(np.int64)


@lru_cache(2)
def load(path: str) -> Pieces:
    return Pieces(path)


@lru_cache(2)
def encoder(path: str) -> WordIds:
    """One encoder per worker process, so that its words serve all tasks there."""
    pieces = load(path)
    # Words between single blanks follow a space mark; words to be taken as they stand are told by a blank before them.
    return WordIds(
        cut=lambda text: text.split(" "),
        odd=lambda word: not word or MARK in word or not pieces.splits,
        cut_odd=lambda text: [" " + word for word in pieces.words(text)],
        encode=lambda words: pieces.merge([w[1:] if w[0] == " " else MARK + w for w in words]),
        limit=100_000,
    )


def _lists(flat: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(flat, pa.int32()))


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str | Column = "text") -> DataFrame:
    """The key and ``ids``, the piece numbers of the whole text, of every row."""
    rows = docs.select(F.col(key).alias("key"), (F.col(text) if isinstance(text, str) else text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(path)
        for batch in chunks(batches, "text", 1 << 20):
            flat, sizes = ids_of(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("key"), _lists(flat, sizes)], names=["key", "ids"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def encode_and_decode(docs: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """The key, ``ids`` and ``decoded``, the text of the ids, of every row, in one pass over the texts."""
    rows = docs.select(F.col(key).alias("key"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, pieces = encoder(path), load(path)
        for batch in chunks(batches, "text", 1 << 20):
            flat, sizes = ids_of(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), _lists(flat, sizes), _texts(pieces, flat.astype(np.int64), sizes)], names=["key", "ids", "decoded"]
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"key {kind}, ids array<int>, decoded string").withColumnRenamed("key", key)


def _texts(pieces: Pieces, flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    flat, lengths = pieces.surfaces(flat, sizes)
    data, at = flat.tobytes(), np.append(0, np.cumsum(lengths)).tolist()
    return pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])], pa.string())


def decode(encoded: DataFrame, path: str, key: str = "doc_id", step: int = 500_000) -> DataFrame:
    """The key, ``ids`` and ``decoded``, the text of the ids, of every row."""
    rows = encoded.select(F.col(key).alias("key"), "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(path)
        for batch in batches:
            lists = batch.column("ids")
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            start = 0
            while start < batch.num_rows:
                done = ends[start - 1] if start else 0
                end = min(max(int(np.searchsorted(ends, done + step, "right")), start + 1), batch.num_rows)
                part = batch.slice(start, end - start)
                own = part.column("ids")
                sizes = own.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                texts = _texts(pieces, own.flatten().to_numpy(zero_copy_only=False).astype(np.int64), sizes)
                yield pa.RecordBatch.from_arrays([part.column("key"), own, texts], names=["key", "ids", "decoded"])
                start = end

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(tidy(run), f"key {kind}, ids array<int>, decoded string").withColumnRenamed("key", key)
