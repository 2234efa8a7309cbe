from __future__ import annotations

import pytest
import sentencepiece

import corpus_pipeline
import odd
from test_near_duplicates import brute as groups
from test_repeats import brute as removed

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    copy = "the quick brown fox jumps over the lazy dog while eleven more wait behind the old stone wall near the river " * 2
    long = " ".join(f"word{i}" for i in range(80))
    leak = "an exam item asks which of these twelve words is never found in any training text"
    spark.createDataFrame(
        [
            (1, copy, "en", "a", 1), (2, copy + "end", "en", "a", 1), (3, None, "en", "a", None), (4, "123", "en", "a", 3),
            (5, " ".join(f"a{i}" for i in range(40)) + long + " tail", "en", "b", 1), (6, " ".join(f"b{i}" for i in range(50)) + long + " other close", "en", "b", 1),
            (7, "before " + leak + " after", "en", "b", 1), (8, "a clean text of its own", None, None, None),
        ],
        odd.SCHEMA,
    ).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_each_stage_acts(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, folder)
        after = {r.doc_id: r for r in docs.collect()}
        if name != "sentence_pieces":
            assert docs.columns == COLUMNS
        kept.append(sorted(after))
        if name == "near_duplicates":
            stay = groups([(i, r.text) for i, r in before.items()], 5)
            assert sorted(after) == sorted(i for i, (_, _, stays) in stay.items() if stays)
        if name == "repeats":
            want = removed([(i, r.text) for i, r in before.items()])
            assert all(len((after[i].text or "").encode()) == want[i][0] - want[i][1] for i in after)
            assert all(r.n_chars == len(r.text) for r in after.values())
        if name == "sentence_pieces":
            library = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.PIECE_MODEL)
            assert all(after[i].ids == library.encode(before[i].text) and after[i].text == before[i].text for i in after)
    assert kept == [[1, 2, 5, 6, 7, 8], [1, 5, 6, 7, 8], [1, 5, 6, 7, 8], [1, 5, 6, 8], [1, 5, 6, 8]]


def test_run_gives_the_same(spark, folder):
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, folder).collect()) == [1, 5, 6, 8]


def test_odd_rows_pass_every_stage(spark, folder):
    docs = odd.with_clashing(odd.documents(spark))
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        if name != "sentence_pieces":
            assert docs.columns == [*COLUMNS, *odd.CLASHING]
    # Copies without an id cannot be told apart, so they stay; so do rows that repeat a doc_id.
    assert sorted(str(r.doc_id) for r in docs.collect()) == sorted(["1", "6", "8", "10", "10", "11", "None"])


def test_decontamination_keeps_clean_rows_that_share_an_id(spark, folder):
    leak = spark.read.parquet(f"{folder}/benchmark.parquet").first().text
    rows = [(i, text) for i in (None, 1) for text in (f"before {leak} after", "a clean text of its own", None)]
    docs = spark.createDataFrame([(i, text, "en", "a", None) for i, text in rows], odd.SCHEMA)
    got = corpus_pipeline.decontaminated(spark, docs, folder).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(((i, t) for i, t in rows if t is None or "before" not in t), key=str)


def test_empty_table(spark, folder):
    docs = odd.nothing(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0
