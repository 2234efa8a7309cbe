from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import odd
from jobscape.llm import sentence_pieces as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts():
    rng = random.Random(1)
    letters = "aabbcdeeilnorst  \n\t.,äéß▁12日本\x00😀"
    fixed = ["hello  world", "  a", "a\tb\nc", " ", "", "é ﬁ Ａ", "▁x", "x   ", "\xa0z", "a" * 50, "    " * 9 + "x", "ab" * 400, "\n\n \n x<s></s><unk><0x0A>", "▁▁ ▁"]
    return fixed + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(3000)] + ["".join(rng.choice("abetisn") for _ in range(5000))]


def test_ids_and_text_are_the_library_s(spark, library):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.ids, r.decoded) for r in sp.decode(sp.encode(df, PATH), PATH).collect()}
    for i, text in rows:
        want = library.encode(text)
        assert got[i] == (want, library.decode(want)), text


def test_one_merge_at_a_time_where_new_pairs_rank_first(library):
    pieces = sp.load(PATH)
    for word in ("▁▁▁▁▁▁▁▁▁", "ababababa", "aaaaaaa", "nananana"):
        ids, sizes = pieces.merge([word])
        assert ids.tolist() == library.encode(word.replace("▁", " ")[1:] if word[0] == "▁" else "x" + word)[-len(ids):] or word[0] != "▁"


def test_decode_any_ids(spark, library):
    lists = [[1, 264, 2], [3, 72, 261], [259, 264], [], [28705, 28705]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in sp.decode(df, PATH).collect()}
    assert [got[i] for i in range(len(lists))] == [library.decode(x) for x in lists]


def test_odd_rows(spark, library):
    df = odd.with_clashing(odd.documents(spark))
    got = sp.encode(df, PATH)
    assert got.columns == ["doc_id", "ids"]
    want = sorted((str(r.doc_id), library.encode(r.text or "")) for r in df.select("doc_id", "text").collect())
    assert sorted((str(r.doc_id), r.ids) for r in got.collect()) == want
    assert sp.decode(sp.encode(odd.nothing(spark), PATH), PATH).count() == 0


def test_query_digests(spark, library, tmp_path):
    import hashlib

    from jobscape.llm.queries import op10_sentence_pieces

    odd.documents(spark).filter(F.col("doc_id") != 10).write.parquet(f"{tmp_path}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in op10_sentence_pieces(spark, str(tmp_path)).collect():
        ids = library.encode(texts[r.doc_id])
        assert tuple(r) == (r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
