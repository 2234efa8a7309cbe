from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

import odd
from jobscape.llm import token_alignment, words
from jobscape.llm.common import text_bytes

BYTES, PIECES, LOWER = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    back = {c: b for b, c in enumerate(words.byte_letters())}
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES), back


def brute(texts, libraries):
    """The contract's columns, with loops over tokens and sets of bytes."""
    a, b, back = libraries
    out, links = [], []
    for text in texts:
        whole = (" " + (text or "")).encode()
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        spell_a = [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a]
        spell_b = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b
        ]
        if not text or b"".join(spell_a) != whole or b"".join(spell_b) != whole:
            out.append((0, 0, 0, ""))
            links.append([])
            continue
        ends_a, ends_b = np.cumsum([len(s) for s in spell_a]).tolist(), np.cumsum([len(s) for s in spell_b]).tolist()
        groups, last = [], 0
        for end in sorted(set(ends_a) & set(ends_b)):
            inside = [",".join(str(i) for i, e in zip(ids, ends) if last < e <= end) for ids, ends in ((ids_a, ends_a), (ids_b, ends_b))]
            groups.append("|".join(inside))
            last = end
        own = []
        for i, end, s in zip(ids_a, ends_a, spell_a):
            own += [(i, j) for j, e, t in zip(ids_b, ends_b, spell_b) if max(end - len(s), e - len(t)) < min(end, e)]
        out.append((len(ids_a), len(ids_b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.append(own)
    count = Counter(pair for own in links for pair in set(own))
    top = defaultdict(int)
    for (i, _), n in count.items():
        top[i] = max(top[i], n)
    return [
        (n_a, n_b, n_groups, len(own), sum(count[p] == top[p[0]] for p in own), sum(count[p] for p in own), digest)
        for (n_a, n_b, n_groups, digest), own in zip(out, links)
    ]


def texts():
    rng = random.Random(7)
    parts = ["the", "The", " ", "  ", "\n", "ing", "é", "日本", "▁", "<|endoftext|>", "</s>", ".", ",", "'s", "\t", "x1", "́", "naïve", "\x00"]
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(250)]
    return [*out, None, "", " ", "a", "the cat sat", "the cat sat", "the cat sat on the mat"]


def result(df, **options):
    rows = token_alignment.align(df, BYTES, PIECES, keep_groups=False, **options).collect()
    return sorted((r.doc_id is not None, r.doc_id or 0, *(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"))) for r in rows)


@pytest.mark.parametrize("block", [8_000_000, 200])
def test_counts_and_groups_equal_brute_force(spark, libraries, block):
    df = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string").repartition(3)
    assert result(df, block=block) == [(True, i, *r) for i, r in enumerate(brute(texts(), libraries))]


def test_odd_rows(spark, libraries):
    rows = [(r.doc_id, r.text if r.text is None or len(r.text) < 5000 else r.text[:5000]) for r in odd.documents(spark).collect()]
    df = odd.with_clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    want = sorted((i is not None, i or 0, *r) for (i, _), r in zip(rows, brute([t for _, t in rows], libraries)))
    assert result(df) == want
    assert token_alignment.align(odd.nothing(spark), BYTES, PIECES).count() == 0
    long = odd.documents(spark).filter("length(text) > 100000")
    assert all(r.n_a > 100_000 for r in token_alignment.align(long, BYTES, PIECES, keep_groups=False).collect())


def test_groups_as_text(spark, libraries):
    a, b, _ = libraries
    df = spark.createDataFrame([(1, "the cat")], "doc_id long, text string")
    (row,) = token_alignment.align(df, BYTES, PIECES).collect()
    ids = [[i] for i in a.encode(" the cat", add_special_tokens=False).ids], [[i] for i in b.encode("the cat")]
    assert row.groups == ";".join(f"{x[0]}|{y[0]}" for x, y in zip(*ids)) and row.n_links == 2


def test_intervals_by_definition():
    rng = random.Random(3)
    for _ in range(200):
        length = rng.randint(1, 12)
        sides = [sorted({0, length, *(rng.randrange(1, length) for _ in range(rng.randint(0, 5)) if length > 1)}) for _ in range(2)]
        (a, b) = (np.array(s) for s in sides)
        group_a, group_b, of_a, of_b = token_alignment.coalesced(a[:-1], a[1:], b[:-1], b[1:])
        want = [(i, j) for i in range(len(a) - 1) for j in range(len(b) - 1) if max(a[i], b[j]) < min(a[i + 1], b[j + 1])]
        assert list(zip(of_a.tolist(), of_b.tolist())) == want
        common = sorted(set(sides[0]) & set(sides[1]))
        assert [np.searchsorted(common, x, "left") - 1 for x in a[1:]] == group_a.tolist()
        assert [np.searchsorted(common, x, "left") - 1 for x in b[1:]] == group_b.tolist()


def random_texts(n):
    rng = random.Random(2)
    letters = "aab  \n\n\tcde's'll \x1c\xa0 éßÉİ.,1<|endoftext|>日٣́"
    parts = ["The", " ", "  ", "\n", "\n\n", ".", ",", "'s", "'", "!?", "É", "<|endoftext|>", "12", "x9", "日本", "́", "\t", "K", "×", "▁"]
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(n)]
    return out + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(n)]


@pytest.mark.parametrize("kind", ["plain", "added", "lower", "pieces"])
def test_words_give_the_ids_of_whole_texts(kind):
    some = random_texts(4000)
    if kind == "pieces":
        model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        ids_of, want, some = words.PieceTokenizer(PIECES, limit=500), model.encode, [t for t in some]
        data, bounds = text_bytes(pa.array([" " + t for t in some]))
    else:
        path, plain = (LOWER if kind == "lower" else BYTES), kind == "plain"
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = plain
        ids_of = words.PatternTokenizer(path, plain, limit=500)
        want = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
        data, bounds = text_bytes(pa.array(some))
    for first in range(0, len(some), 500):
        part = bounds[first : first + 501]
        flat, sizes = ids_of(data[part[0] : part[-1]], part - part[0])
        ends = np.cumsum(sizes)
        for text, a, b in zip(some[first:], ends - sizes, ends):
            assert flat[a:b].tolist() == want(text), text


def test_query(spark, libraries):
    from jobscape.llm.queries import QUERIES

    df = QUERIES["op13_token_alignment"](spark, "/root/testdata/sf0.001")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    short = {i for i, t in rows if len(t) < 1500}
    got = {r.doc_id: r for r in df.collect()}
    assert df.columns == ["doc_id", *COLUMNS] and len(got) == len(rows)
    for (i, _), want in zip(rows, brute([t if i in short else None for i, t in rows], libraries)):
        if i in short:
            assert tuple(got[i][c] for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")) == (*want[:4], want[6])
