from __future__ import annotations

import re
from itertools import permutations

import odd
from jobscape.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int"


def brute(docs, labels):
    """The contract's columns, document by document."""
    rows = []
    for doc, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text):
            fails.add("C")
        if re.search("[#$%&*|]", text):
            fails.add("D")
        if doc is not None and any(o is not None and o < doc and (t or "") == text for o, t, _ in docs):
            fails.add("E")
        good = any(i == doc and i is not None and q == 1 for i, q, _ in labels)
        toxic = any(i == doc and i is not None and t == 1 for i, _, t in labels)
        rows.append((lang or "", fails, good, toxic))
    out = {}
    for part in {r[0] for r in rows}:
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            for step, name in enumerate(order, 1):
                gone = [r for r in left if name in r[1]]
                left = [r for r in left if name not in r[1]]
                shapley[name] += len(gone)
                all_fails = sum(r[0] == part and name in r[1] for r in rows)
                only = sum(r[0] == part and r[1] == {name} for r in rows)
                out[part, "".join(order), step] = (len(left), len(gone), all_fails - len(gone), only, sum(r[2] for r in gone), sum(r[3] for r in gone))
        for key in [k for k in out if k[0] == part]:
            out[key] += (shapley[key[1][key[2] - 1]],)
    return out


def result(df, labels):
    rows = filter_audit.audit(df, labels).collect()
    return {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in rows
    }


def documents():
    words = "the cat sat on a mat and looked at every dog that went by".split()
    long = " ".join(words[i % 13] + str(i) for i in range(250))
    same = " ".join(words[i % 5] for i in range(250))
    docs = [(i, long, "en") for i in (3, 1, 2, 2)] + [(i, same, "en") for i in (10, 11)]
    docs += [(20, long + " $", "de"), (21, long + " $", None), (22, long.upper(), "de"), (23, "Short | Text", ""), (24, " \x0b" + long + "\n", "fr")]
    docs += [(30, None, None), (31, "", "en"), (None, None, "en"), (None, long, "en"), (None, long, None), (32, long + " x" * 60, "fr"), (33, "é" * 97 + "AAA", "fr"), (34, "é" * 96 + "AAAA", "fr")]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (10, None, None), (11, 1, 1), (23, 0, 1), (None, 1, 1), (99, 1, 1), (20, 1, 0), (21, 1, 0)]
    return docs, labels


def test_every_step_equals_brute_force(spark):
    docs, labels = documents()
    df = odd.with_clashing(spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3))
    got = result(df, spark.createDataFrame(labels, LABELS))
    assert got == brute(docs, labels) and len(got) == 600 * len({lang or "" for _, _, lang in docs})


def test_odd_rows(spark):
    df = odd.documents(spark)
    docs = [(r.doc_id, r.text, r.lang) for r in df.collect()]
    assert result(odd.with_clashing(df), spark.createDataFrame([], LABELS)) == brute(docs, [])
    assert filter_audit.audit(odd.nothing(spark), spark.createDataFrame([], LABELS)).count() == 0


def test_copies_over_slices_and_equal_hashes(spark):
    from pyspark.sql import functions as F

    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("en").alias("part"), F.when(F.col("id") % 7 == 0, "rare").otherwise("hot").alias("text"))
    hashed = docs.select("doc_id", F.xxhash64("text").alias("hash"))
    got = filter_audit.copies(docs, hashed, slice_rows=10).collect()
    assert sorted(r.doc_id for r in got) == [i for i in range(500) if i not in (0, 1)]
