from __future__ import annotations

import zlib

import odd
from jobscape.llm import language_id as li

SF_DIR = "/root/testdata/sf0.001"


def pieces(codes, train):
    """Pieces of the longest matches, by trying every substring."""
    text, known = "".join(map(chr, codes)), "".join(map(chr, train))
    at = count = 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in known:
            end += 1
        at, count = max(end - 1, at + 1), count + 1
    return count


def test_pieces_are_longest_matches():
    model = (("a", "the cat sat on the mat "), ("b", "der hund und die katze"))
    classes, automata = li._tables(model)
    for text in ("the hat on the cat", "der mat", "zzz the", "ñandu", "a", "the  --  the", "catcatcat xyz katze"):
        codes = li._squeezed(classes[li._points(text)])[0]
        found, _ = li.entropies([text], model)
        for k, (_, train) in enumerate(model):
            want = pieces(codes.tolist(), li._squeezed(classes[li._points(train)])[0].tolist())
            assert round(found[0, k] * len(codes) / automata[k][2]) == want


def test_blocks_and_neighbours_do_not_matter():
    model = (("a", "the cat sat on the mat "), ("b", "der hund und die katze"))
    texts = ["the cat " * 300, "", "katze", "12", "hund " * 150]
    together, _ = li.entropies(texts, model)
    for text, row in zip(texts, together):
        assert li.entropies([text], model)[0][0].tolist() == row.tolist()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = li.identify(docs, li.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)


def test_held_out_rows_teach_nothing(spark):
    rows = [(i, "only here", "xx") for i in range(200) if zlib.crc32(str(i).encode()) % 3 == 1] + [(None, "no id", "yy")]
    assert li.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string")) == ()


def test_odd_rows(spark):
    df = odd.with_clashing(odd.documents(spark))
    model = li.fit(df)
    got = {(r.doc_id, r.lang_pred) for r in li.identify(df, model).collect()}
    assert {lang for lang, _ in model} <= {"en", "de", "la"}
    assert {(3, "und"), (4, "und"), (5, "und"), (9, "und")} <= got
    assert li.identify(df, model).count() == df.count()
    assert {r.lang_pred for r in li.identify(df, ()).collect()} == {"und"}
    assert li.fit(odd.nothing(spark)) == () and li.identify(odd.nothing(spark), model).count() == 0
    assert all(r.score in (0.0, 1.0) for r in li.identify(df, model[:1]).collect())


def test_fit_is_bounded(spark):
    model = li.fit(odd.documents(spark), chars_per_language=1000)
    assert all(len(text) <= 1000 for _, text in model)
