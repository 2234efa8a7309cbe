from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import odd
from jobscape.llm import token_shards as ts
from jobscape.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def round_trip(spark, df):
    folder = scratch_path(spark, "test-shards")
    dictionary = ts.train_dictionary(df, PATH)
    manifest = ts.write_shards(df, folder, PATH, dictionary)
    return folder, dictionary, manifest, ts.read_shards(spark, folder)


def test_words_are_cut_where_tokens_end(library):
    rng = random.Random(2)
    letters = "aab  \n\n\tcde's'll \x1c\xa0 éß.,1<|endoftext|>日"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(5000)]
    ids, sizes = ts.encoder(PATH)[0](texts)
    ends = np.cumsum(sizes)
    for text, start, end in zip(texts, ends - sizes, ends):
        assert ids[start:end].tolist() == library(text), text


def test_round_trip_of_odd_rows(spark, library):
    df = odd.with_clashing(odd.documents(spark)).repartition(4)
    folder, dictionary, manifest, back = round_trip(spark, df)
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in df.select("doc_id", "text").collect()))
    got = sorted(back.collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [i if there else None for there, i, _ in rows]
    start = 0
    for (_, _, text), r in zip(rows, got):
        ids = library(text) + [0]
        assert (r.start, r.n_tokens, bytes(r.ids)) == (start, len(ids), np.array(ids, "<u4").tobytes())
        start += len(ids)
    first = manifest.orderBy("shard").first()
    assert ts.read_document(folder, first.file, 0, dictionary).tolist() == np.frombuffer(got[0].ids, "<u4").tolist()
    with pytest.raises(ValueError, match="another dictionary"):
        ts.read_document(folder, first.file, 0, dictionary + b"x")


def test_added_tokens_are_as_in_the_plain_library(spark):
    plain = Tokenizer.from_file(PATH)
    rng = random.Random(3)
    parts = ["<|endoftext|>", " ", "\n", "a", "word", ".", "é", "<|endoftext", "|>"]
    texts = ["a<|endoftext|>b", None, "plain text", "<|endoftext|>", "", " <|endoftext|> <|endoftext|>\n"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert want[0] == [64, 50256, 65]
    ids, sizes = ts.encoder(PATH)[0](texts)
    ends = np.cumsum(sizes)
    assert [ids[a:b].tolist() for a, b in zip(ends - sizes, ends)] == want
    back = round_trip(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))[3]
    start = 0
    for r, own in zip(sorted(back.collect(), key=lambda r: r.doc_id), want):
        assert (r.start, np.frombuffer(r.ids, "<u4").tolist()) == (start, [*own, 0])
        start += r.n_tokens


def test_no_documents(spark):
    assert round_trip(spark, odd.nothing(spark))[3].count() == 0


def test_query_checksums(spark, library, tmp_path):
    from jobscape.llm.queries import op5_token_shards

    rows = [(i, f"text number {i} " * (i % 5)) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    start, want = 0, []
    for i, text in rows:
        ids = library(text) + [0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, op5_token_shards(spark, str(tmp_path)).collect())) == want
