from __future__ import annotations

import random

import odd
from jobscape.llm import decontamination as dc

ITEMS = "item_id long, text string"


def corpus():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    some = lambda n: [rng.choice(words) for _ in range(n)]
    items = [some(rng.randint(12, 60)) for _ in range(20)] + [some(9), some(5), some(3)]
    docs, want = [], set()
    for i in range(120):
        body = some(rng.randint(0, 200))
        if i % 3:
            k = rng.randrange(20)
            copy = list(items[k])
            for at in range(rng.randint(4, 8), len(copy), rng.choice((5, 8, 100))):
                copy[at] = "changed"
            at = rng.randint(0, len(body))
            body = body[:at] + [w.upper() + rng.choice(("", ".", ",")) for w in copy] + body[at:]
            want.add((i, k))
        docs.append((i, " ".join(body)))
    docs.append((500, " ".join(items[20])))
    want.add((500, 20))
    # A short item counts whole only, and below MIN_WORDS not at all.
    docs.append((501, " ".join(some(3) + items[21] + some(3))))
    want.add((501, 21))
    docs.append((502, " ".join(items[21][:4] + ["changed"] + items[22])))
    return docs, [(k, " ".join(w)) for k, w in enumerate(items)], want


def brute(docs, items):
    """Pairs whose best alignment passes, over every offset."""
    found = set()
    for i, text in docs:
        doc = [w.strip(".,").lower() for w in text.split()]
        for k, item in items:
            own = item.split()
            if len(own) < dc.MIN_WORDS:
                continue
            for first in range(1 - len(own), len(doc)):
                score = best = matched = 0
                for j, w in enumerate(own):
                    if 0 <= first + j < len(doc):
                        same = doc[first + j] == w
                        score, matched = (score + 1, matched + 1) if same else (score - 2, matched)
                        if score <= 0:
                            score = matched = 0
                        best = max(best, matched) if same else best
                least = min(dc.LEAST, -(-int(dc.SHORT_SHARE * 10) * len(own) // 10))
                if best >= (len(own) if len(own) < dc.SEED_WORDS else least):
                    found.add((i, k))
    return found


def test_finds_passages_with_changed_words(spark):
    docs, items, want = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, ITEMS)
    for block_bytes in (1 << 22, 600):
        got = dc.contaminated_spans(df, bench, block_bytes).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want == brute(docs, items)
        texts = dict(docs)
        for r in got:
            passage = texts[r.doc_id].encode()[r.byte_start : r.byte_end].decode()
            assert len(passage.split()) == r.words >= r.matched


def test_every_third_or_fourth_word_replaced(spark):
    rng = random.Random(6)
    docs, want = [], {}
    items = [(k, " ".join(f"i{k}w{j}" for j in range(n))) for k, n in enumerate((17, 18, 19, 20, 31, 59))]
    for k, text in items:
        for period in (3, 4, 0):
            for shift in range(period or 3):
                copy, at = text.split(), shift
                while at < len(copy):
                    copy[at] = f"new{at}"
                    at += period or rng.choice((3, 4, 5))
                want[len(docs)] = (k, sum(not w.startswith("new") for w in copy))
                docs.append((len(docs), " ".join(["before", *copy, "after"])))
    got = dc.contaminated_spans(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)).collect()
    assert {r.doc_id: r.item_id for r in got} == {i: k for i, (k, _) in want.items()}
    # A lone equal word at either end is left out.
    assert all(want[r.doc_id][1] - 2 <= r.matched <= want[r.doc_id][1] for r in got)


def test_clean_documents_and_long_items(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    long = " ".join(f"q{i}" for i in range(30_000))
    items = spark.createDataFrame([(1, long), (2, None), (3, ""), (4, "a b c")], ITEMS)
    assert dc.contaminated_spans(docs, items).count() == 0
    part = spark.createDataFrame([(1, " ".join(f"q{i}" for i in range(20_000, 20_040)))], "doc_id long, text string")
    assert {r.item_id for r in dc.contaminated_spans(part, items).collect()} == {1}


def test_odd_rows(spark):
    df = odd.with_clashing(odd.documents(spark))
    bench = spark.createDataFrame([(7, "The cat, sat on the mat and looked at the dog!")] * 2, ITEMS)
    got = dc.contaminated_spans(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 7), (2, 7)}
    assert dc.contaminated_spans(odd.nothing(spark), bench).count() == 0
    assert dc.contaminated_spans(df, spark.createDataFrame([], ITEMS)).count() == 0
