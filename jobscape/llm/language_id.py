"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is cut, from left to right, into the
longest pieces that occur in that labelled text; related text needs few pieces. With ``c`` pieces over ``n``
characters against ``m`` characters of labelled text the cross entropy is about ``c * log2(m) / n``, and the
language with the smallest one wins.

Letters are lower-cased, and every run of other characters counts as one space. Automata are dense tables, so that
many blocks of text advance together, one numpy step per character; a text is cut into blocks of ``BLOCK``
characters at which pieces end, whatever its length, and all blocks of the text count.

Rules: a null text or one without letters is ``und`` with score 0; a table without labelled rows makes every text
``und``; with one language the score is 1; equal entropies go to the smaller name. Rows without a doc_id are
answered but never learnt from. Repeated rows are answered alike. Columns other than doc_id, text (and lang, while
learning) are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from jobscape.llm.common import chunks, tidy

UNKNOWN = "und"
BLOCK = 512
# Letters with a class of their own; the rest share the classes after them.
OWN_LETTERS, SHARED = 110, 15


@lru_cache(1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: its lower case where that is one code point, and whether it is a letter."""
    points = range(0x110000)
    low = np.fromiter((ord(y) if len(y := chr(i).lower()) == 1 else i for i in points), np.uint32, 0x110000)
    return low, np.fromiter((chr(i).isalpha() for i in points), np.bool_, 0x110000)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _automaton(codes: list[int]) -> list[dict[int, int]]:
    """Edges of the suffix automaton of a sequence; state 0 is the start."""
    edges: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in edges[p]:
            edges[p][c] = new
            p = link[p]
        if p >= 0:
            q = edges[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(edges)
                edges.append(dict(edges[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[new] = twin
                while p >= 0 and edges[p].get(c) == q:
                    edges[p][c] = twin
                    p = link[p]
        last = new
    return edges


def _dense(codes: np.ndarray, classes: int) -> np.ndarray:
    """Per state and class: twice the next row's offset, plus 1 where a piece ends before the character."""
    edges = _automaton(codes.tolist())
    lost = len(edges)  # the state after a character that the labelled text lacks; the next one starts a piece
    start = np.full(classes, lost, np.int32)
    start[list(edges[0])] = list(edges[0].values())
    out = np.tile(start * (classes * 2) + 1, (lost + 1, 1))
    out[0] -= 1
    for state, own in enumerate(edges):
        if own:
            out[state, list(own)] = np.fromiter(own.values(), np.int32, len(own)) * (classes * 2)
    return out.reshape(-1)


@lru_cache(1)
def _tables(model: tuple[tuple[str, str], ...]) -> tuple[np.ndarray, list[tuple[str, np.ndarray, float]]]:
    """Class of each code point, and the automaton of each language."""
    low, letter = _letters()
    points = low[_points("".join(text for _, text in model))]
    seen, counts = np.unique(points[letter[points]], return_counts=True)
    own = seen[np.lexsort((seen, -counts))][:OWN_LETTERS]
    classes = np.where(letter[low], 1 + len(own) + low % SHARED, 0).astype(np.uint8)
    direct = np.zeros(0x110000, np.uint8)
    direct[own] = 1 + np.arange(len(own))
    classes = np.where(direct[low] > 0, direct[low], classes)
    out = []
    for lang, text in model:
        codes = _squeezed(classes[_points(text)])[0]
        out.append((lang, _dense(codes, 1 + len(own) + SHARED), float(np.log2(len(codes) + 2))))
    return classes, out


def _squeezed(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of class 0 shortened to one, and which were kept."""
    keep = np.ones(len(codes), np.bool_)
    keep[1:] = (codes[1:] > 0) | (codes[:-1] > 0)
    return codes[keep], keep


def _pieces(table: np.ndarray, grid: np.ndarray, active: np.ndarray) -> np.ndarray:
    """Pieces of each column of ``grid``; the first ``active[t]`` columns reach row t."""
    state = np.zeros(grid.shape[1], np.int32)
    count = np.ones(grid.shape[1], np.int32)
    for row, n in zip(grid, active.tolist(), strict=True):
        step = table[state[:n] + row[:n]]
        count[:n] += step & 1
        state[:n] = step >> 1
    return count


def entropies(texts: list[str], model: tuple[tuple[str, str], ...]) -> tuple[np.ndarray, np.ndarray]:
    """Cross entropy of every text against every language, and the number of letters of each text."""
    classes, automata = _tables(model)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = classes[_points("".join(texts))]
    row = np.repeat(np.arange(len(texts)), sizes)
    letters = np.bincount(row[codes > 0], minlength=len(texts))
    keep = np.ones(len(codes), np.bool_)
    keep[1:] = (codes[1:] > 0) | (codes[:-1] > 0) | (row[1:] != row[:-1])
    codes, row = codes[keep], row[keep]
    sizes = np.bincount(row, minlength=len(texts))
    blocks = -(-sizes // BLOCK)
    owner = np.repeat(np.arange(len(texts)), blocks)
    nth = np.arange(len(owner)) - (np.cumsum(blocks) - blocks)[owner]
    lane_len = np.minimum(BLOCK, sizes[owner] - nth * BLOCK)
    lane_at = (np.cumsum(sizes) - sizes)[owner] + nth * BLOCK
    order = np.argsort(-lane_len, kind="stable")
    owner, lane_len, lane_at = owner[order], lane_len[order], lane_at[order]
    padded = np.concatenate((codes, np.zeros(BLOCK, np.uint8)))
    grid = padded[np.arange(BLOCK)[:, None] + lane_at[None, :]].astype(np.int32) if len(owner) else np.zeros((0, 0), np.int32)
    active = np.searchsorted(-lane_len, -np.arange(len(grid)), "left")
    out = np.zeros((len(texts), len(automata)))
    for k, (_, table, bits) in enumerate(automata):
        if len(owner):
            pieces = np.bincount(owner, _pieces(table, grid, active), len(texts))
            out[:, k] = pieces * bits / np.maximum(sizes, 1)
    return out, letters


def fit(
    docs: DataFrame, chars_per_language: int = 16_384, docs_per_language: int = 64
) -> tuple[tuple[str, str], ...]:
    """Labelled text per language: at most ``chars_per_language`` characters out of ``docs_per_language`` documents.

    The documents are those whose hashed id is smallest among the ones with a label, a text with letters and
    ``crc32(doc_id) mod 3`` other than 1. The sample is bounded, whatever the size of the table.
    """
    share = chars_per_language // 8
    rows = docs.filter(
        F.col("lang").isNotNull() & (remainder() != 1) & F.col("text").rlike(r"\p{L}")
    ).select(
        F.col("lang").cast("string").alias("lang"),
        F.substring("text", 1, share).alias("text"),
        F.xxhash64("doc_id").alias("place"),
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "text"))
    texts: dict[str, str] = {}
    for r in sorted(rows.withColumn("n", rank).filter(F.col("n") <= docs_per_language).collect(), key=lambda r: r.n):
        texts[r.lang] = (texts.get(r.lang, "") + " " + r.text)[: chars_per_language]
    return tuple(sorted(texts.items()))


def remainder():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3


def identify(docs: DataFrame, model: tuple[tuple[str, str], ...], carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, and the ``carried`` columns."""
    held_out = F.coalesce(remainder() == 1, F.lit(False)).alias("held_out")
    rows = docs.select("doc_id", held_out, F.col("text").cast("string"), *carried)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([lang for lang, _ in model] or [UNKNOWN])
        for batch in chunks(batches, "text", 2 << 20):
            if not model:
                lang, score = np.full(batch.num_rows, UNKNOWN), np.zeros(batch.num_rows)
            else:
                found, letters = entropies([t or "" for t in batch.column("text").to_pylist()], model)
                best = found.argmin(1)
                if len(model) > 1:
                    low = np.partition(found, 1, axis=1)
                    score = low[:, 1] / np.maximum(low[:, 0] + low[:, 1], 1e-12)
                else:
                    score = np.ones(batch.num_rows)
                lang = np.where(letters > 0, names[best], UNKNOWN)
                score = np.where(letters > 0, score, 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(lang.tolist(), pa.string()), pa.array(score), *map(batch.column, carried)],
                names=["doc_id", "held_out", "lang_pred", "score", *carried],
            )

    kinds = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carried)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidy(predict), f"doc_id {kind}, held_out boolean, lang_pred string, score double{kinds}")
