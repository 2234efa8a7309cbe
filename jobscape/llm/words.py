"""Token ids of many texts through their distinct words.

The bytes of a batch are cut, in numpy, at places where no token can reach across; Arrow finds the distinct words of
the batch, and only those not met before are encoded by the tokenizer's library. A cut is made only where the
characters beside it prove it, so that the ids equal those of the whole text; a text without such places is one word.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa

# Kinds of bytes: letters, digits, signs, blanks and line ends; of all others nothing is known.
OTHER, LETTER, DIGIT, SIGN, APOSTROPHE, BLANK, LINE = range(7)


def _kinds() -> np.ndarray:
    out = np.full(256, OTHER, np.uint8)
    for i in range(33, 127):
        c = chr(i)
        out[i] = LETTER if c.isalpha() else DIGIT if c.isdigit() else APOSTROPHE if c == "'" else SIGN
    out[32], out[10] = BLANK, LINE
    return out


KINDS = _kinds()
MARK_BYTES = "▁".encode()
# Words of these shapes are one pre-token: a run of letters, digits or signs, with a blank before it or not.
PLAIN = re.compile(r" ?(?:[A-Za-zÀ-ÖØ-öø-ɏ]+|[0-9]+|[!-/:-@\[-`{-~]+)|\n")
PLAIN_LOWER = re.compile(r" ?(?:[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+)")


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in own}
    for b in range(256):
        out.setdefault(b, chr(256 + len(out) - len(own)))
    return [out[b] for b in range(256)]


def pattern_cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Cuts between pre-tokens of the usual patterns (an optional blank and letters, digits or signs; white space).

    Before a blank that a visible character follows; between letters or digits and signs; between signs (no
    apostrophe) and letters or digits; and around a line end that follows a letter, digit or sign and is followed by
    one. Latin letters beyond ASCII count as letters, all else is left uncut.
    """
    kind = KINDS[data]
    lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC8))
    if len(lead):
        after = data[np.minimum(lead + 1, len(data) - 1)]
        sign = (data[lead] == 0xC3) & ((after == 0x97) | (after == 0xB7))
        # The capital dotted I becomes a letter and a mark in lower case.
        sign |= (data[lead] == 0xC4) & (after == 0xB0)
        lead = lead[(lead + 1 < len(data)) & ~sign]
        kind[lead] = LETTER
        kind[lead + 1] = LETTER
    n = len(data)
    cut = np.zeros(n + 1, np.bool_)
    if n > 1:
        left, right = kind[:-1], kind[1:]
        word_left, word_right = (left == LETTER) | (left == DIGIT), (right == LETTER) | (right == DIGIT)
        sign_right = (right == SIGN) | (right == APOSTROPHE)
        cut[1:-1] = (word_left & sign_right) | ((left == SIGN) & word_right)
        # Before a blank when something visible of the same row follows it.
        blank = np.flatnonzero((left == BLANK) & (word_right | sign_right))
        first = np.zeros(n + 1, np.bool_)
        first[bounds] = True
        cut[blank[~first[blank + 1]]] = True
        line = np.flatnonzero(right == LINE) + 1
        line = line[(kind[line - 1] >= LETTER) & (kind[line - 1] <= APOSTROPHE) & (line + 1 < n)]
        line = line[(kind[line + 1] >= LETTER) & (kind[line + 1] <= APOSTROPHE)]
        cut[line] = True
        cut[line + 1] = True
    cut[bounds] = True
    return np.flatnonzero(cut)


def piece_cuts(pieces: list[str]) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Cuts for a vocabulary without pre-tokens: where no piece holds the two characters side by side."""
    beside = np.zeros((256, 256), np.bool_)
    for piece in pieces:
        for a, b in zip(piece, piece[1:]):
            beside[min(ord(a), 128), min(ord(b), 128)] = True
    # All characters beyond ASCII count as one; between two of them nothing is cut.
    beside[129:], beside[:, 129:] = beside[128], beside[:, 128:129]
    beside[128:, 128:] = True
    flat = beside.ravel()

    def cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        cut = np.zeros(len(data) + 1, np.bool_)
        if len(data) > 1:
            cut[1:-1] = ~flat[data[:-1].astype(np.uint16) << 8 | data[1:]]
        cut[bounds] = True
        return np.flatnonzero(cut)

    return cuts


class WordMemory:
    """Ids of words; ``encode`` is asked once for a word until it is forgotten.

    Past ``limit`` words (or 32 bytes for each of them) those used in a single batch go first, then the less used
    half; words of more than ``longest`` bytes are never kept.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]], limit: int = 400_000, longest: int = 48):
        self.encode, self.limit, self.longest = encode, limit, longest
        self.place: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int32)
        self.filled = self.held_bytes = 0

    def _forget(self) -> None:
        keep = np.array([len(w) <= self.longest for w in self.place]) & (self.uses > 1)
        if keep.sum() > self.limit // 2:
            least = np.partition(self.uses[keep], -(self.limit // 2))[-(self.limit // 2)]
            keep &= self.uses > least
        words = [w for w, k in zip(self.place, keep.tolist()) if k]
        starts, sizes = self.starts[keep], self.sizes[keep]
        begin = np.cumsum(sizes) - sizes
        ids = self.ids[np.repeat(starts - begin, sizes) + np.arange(sizes.sum())]
        self.filled = len(ids)
        self.ids = np.concatenate((ids, np.zeros(1 << 16, np.int32)))
        self.starts, self.sizes, self.uses = begin, sizes, self.uses[keep] // 2
        self.place = {w: i for i, w in enumerate(words)}
        self.held_bytes = sum(map(len, words))

    def _learn(self, words: list[bytes]) -> None:
        found = self.encode(words)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        total = int(sizes.sum())
        if self.filled + total > len(self.ids):
            self.ids = np.concatenate((self.ids[: self.filled], np.zeros(max(total, self.filled // 2) + (1 << 16), np.int32)))
        self.ids[self.filled : self.filled + total] = np.fromiter((i for ids in found for i in ids), np.int32, total)
        self.starts = np.concatenate((self.starts, self.filled + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.uses = np.concatenate((self.uses, np.zeros(len(words), np.int32)))
        self.filled += total
        self.held_bytes += sum(map(len, words))

    def __call__(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words between ``cuts``, end to end, and how many each word has."""
        if len(cuts) < 2:
            return self.ids[:0], np.zeros(0, np.int64)
        if len(self.place) > self.limit or self.held_bytes > 32 * self.limit:
            self._forget()
        offsets = pa.py_buffer(np.ascontiguousarray(cuts, np.int64))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, offsets, pa.py_buffer(data)])
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        place, size = self.place, len(self.place)
        fresh = [w for w in distinct if w not in place]
        if fresh:
            place.update(zip(fresh, range(size, size + len(fresh))))
            self._learn(fresh)
        at = np.fromiter(map(place.__getitem__, distinct), np.int64, len(distinct))
        self.uses[at] += 1
        of = at[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = self.sizes[of]
        begin = np.cumsum(sizes) - sizes
        return self.ids[np.repeat(self.starts[of] - begin, sizes) + np.arange(sizes.sum())], sizes


def per_row(sizes: np.ndarray, cuts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many ids each row has, from those of its words; every bound is a cut."""
    ends = np.append(0, np.cumsum(sizes))
    return np.diff(ends[np.searchsorted(cuts, bounds)])


class PatternTokenizer:
    """A byte-level tokenizer file with a pattern of words, on rows of UTF-8 bytes.

    ``added_are_text`` takes the strings of added tokens as plain text; else texts that hold one are encoded whole.
    """

    def __init__(self, path: str, added_are_text: bool = False, limit: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = added_are_text
        added = [] if added_are_text else self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content.encode() for t in added]
        normal = self.tokenizer.normalizer
        self.lower = normal is not None and "Lowercase" in str(normal)
        self.plain = PLAIN_LOWER if self.lower else PLAIN
        model, letters = self.tokenizer.model, "".join(byte_letters())
        table = {i: c for i, c in enumerate(letters)}

        def encode(words: list[bytes]) -> list[list[int]]:
            out: list[list[int]] = []
            odd: list[str] = []
            at: list[int] = []
            for i, raw in enumerate(words):
                word = raw.decode("utf-8", "replace")
                if self.plain.fullmatch(word):
                    # White space between words is dropped with the lower case files.
                    own = raw.lstrip(b" ") if self.lower else raw
                    out.append([t.id for t in model.tokenize(own.decode("latin-1").translate(table))])
                else:
                    out.append([])
                    odd.append(word)
                    at.append(i)
            for i, found in zip(at, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)):
                out[i] = found.ids
            return out

        self.words = WordMemory(encode, limit)

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows end to end, and how many each row has."""
        whole: list[int] = []
        raw = data.tobytes() if self.added else b""
        if any(a in raw for a in self.added):
            rows = (raw[a:b] for a, b in zip(bounds.tolist(), bounds[1:].tolist()))
            whole = [i for i, row in enumerate(rows) if any(a in row for a in self.added)]
        if self.lower:
            data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8) if not whole else data
        cuts = pattern_cuts(data, bounds)
        flat, sizes = self.words(data, cuts)
        counts = per_row(sizes, cuts, bounds)
        if whole:
            flat, counts = self._with_whole(data, bounds, flat, counts, whole)
        return flat, counts

    def _with_whole(self, data, bounds, flat, counts, whole) -> tuple[np.ndarray, np.ndarray]:
        texts = [data[bounds[i] : bounds[i + 1]].tobytes().decode("utf-8", "replace") for i in whole]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ends = np.cumsum(counts)
        parts, last = [], 0
        for i, ids in zip(whole, found):
            parts += [flat[last : ends[i] - counts[i]], np.array(ids, np.int32)]
            last = ends[i]
        counts = counts.copy()
        counts[whole] = [len(ids) for ids in found]
        return np.concatenate([*parts, flat[last:]]), counts

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id."""
        back = {c: b for b, c in enumerate(byte_letters())}
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        out = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            out[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        return out


@lru_cache(4)
def pattern_tokenizer(path: str, added_are_text: bool = False) -> PatternTokenizer:
    """One per worker process, so that its words serve all tasks there."""
    return PatternTokenizer(path, added_are_text)


class PieceTokenizer:
    """A SentencePiece BPE model on rows of UTF-8 bytes that start with the blank the model adds."""

    def __init__(self, path: str, limit: int = 400_000):
        import sentencepiece

        from jobscape.llm.sentence_pieces import MARK, load

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.texts = [model.id_to_piece(i) for i in range(n)]
        self.byte = [model.is_byte(i) for i in range(n)]
        usable = [i for i in range(n) if not (self.byte[i] or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.cuts = piece_cuts([self.texts[i].replace(MARK, " ") for i in usable])
        pieces = load(path)

        def encode(words: list[bytes]) -> list[list[int]]:
            texts = [w.decode("utf-8", "replace") for w in words]
            led = [t[:1] == " " and " " not in t[1:] and len(t) > 1 and MARK not in t for t in texts]
            found = iter(model.encode([t[1:] for t, k in zip(texts, led) if k], num_threads=1))
            rest = [t.replace(" ", MARK) for t, k in zip(texts, led) if not k]
            flat, sizes = pieces.merge(rest)
            ends = np.cumsum(sizes)
            own = iter([flat[a:b].tolist() for a, b in zip(ends - sizes, ends)])
            return [next(found) if k else next(own) for k in led]

        self.words = WordMemory(encode, limit)

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # A space mark in a text stands beside blanks as one of them: such a batch is not cut.
        cuts = np.unique(bounds) if MARK_BYTES in data.tobytes() else self.cuts(data, bounds)
        flat, sizes = self.words(data, cuts)
        return flat, per_row(sizes, cuts, bounds)

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id: space marks as blanks, byte pieces as their byte."""
        return [
            bytes([int(t[3:5], 16)]) if b else t.replace("▁", " ").encode() for t, b in zip(self.texts, self.byte)
        ]


@lru_cache(2)
def piece_tokenizer(path: str) -> PieceTokenizer:
    return PieceTokenizer(path)
