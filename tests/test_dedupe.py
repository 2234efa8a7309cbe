from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from jobscape.operators import dedupe, paging
from jobscape.operators.scale import top_per_key

FETCHED = [(1, "s1", 0, "7"), (1, "s1", 1, "8"), (1, "s1", 2, ""), (2, "s2", 0, "8"), (2, "s2", 1, "9"), (2, "s2", 2, "9"), (2, "s2", 3, None)]


@pytest.fixture
def fetched(spark):
    return spark.createDataFrame(FETCHED, "rank int, search string, pos int, id string")


def test_keep_first(fetched, rows):
    first = dedupe.keep_first(fetched, "id", ["rank", "pos"])
    assert rows(first.select("id", "search", "pos")) == [("7", "s1", 0), ("8", "s1", 1), ("9", "s2", 1)]
    assert rows(dedupe.keep_first(first, "id", ["rank", "pos"])) == rows(first)


def test_keep_last(fetched, rows):
    assert rows(dedupe.keep_last(fetched, "id", ["rank", "pos"]).select("id", "search", "pos")) == [
        ("7", "s1", 0), ("8", "s2", 0), ("9", "s2", 2),
    ]


def test_counters(spark, fetched, rows):
    searches = spark.createDataFrame([("s1", 1), ("s2", 2), ("s3", 3)], "search string, rank int")
    got = dedupe.extraction_counters(fetched, searches, "search", "rank", "id")
    assert rows(got.select("search", "fetched", "added", "duplicates")) == sorted(
        [("s1", 3, 2, 1), ("s2", 4, 1, 3), ("s3", 0, 0, 0), (None, 7, 3, 4)], key=repr
    )


def test_upsert(spark, rows):
    stored = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "id int, v string, seq int")
    new = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "id int, v string, seq int")
    assert rows(dedupe.upsert(stored, new, "id", ["seq"]).select("id", "v")) == [(1, "a"), (2, "d"), (3, "e")]


def test_upsert_refuses_missing_key(spark):
    new = spark.createDataFrame([(None, "c", 1)], "id int, v string, seq int")
    with pytest.raises(Exception, match="null in key column"):
        dedupe.upsert(new.limit(0), new, "id", ["seq"]).collect()


@pytest.mark.parametrize("n", [1, 5, 40, 1500])
def test_top_per_key_equals_brute_force(spark, n):
    """One key holds a third of the rows, and many of its rows are copies of one row."""
    rng = random.Random(n)
    data = [("hot", 1, 1)] * 1000 + [(rng.choice(["hot", "a", "b"]), rng.randrange(50), i) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, v int, i int").repartition(7)
    got = top_per_key(df, ["k"], [F.col("v").desc(), F.col("i")], n)
    want = []
    for key in {r[0] for r in data}:
        want += sorted((r for r in data if r[0] == key), key=lambda r: (-r[1], r[2]))[:n]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_rows_are_cut_before_the_shuffle(spark, fetched):
    plan = dedupe.keep_first(fetched, "id", ["rank", "pos"])._jdf.queryExecution().toString()
    physical = plan[plan.index("Physical Plan"):]
    assert physical.index("Final") < physical.index("Exchange") < physical.index("Partial")


def test_page_plan(spark, rows):
    totals = spark.createDataFrame([(t,) for t in (0, None, 1, 150, 151, 4000)], "total int")
    ranges = paging.page_ranges(totals, "total", paging.MAX_RESULTS)
    by_total = {}
    for r in ranges.collect():
        by_total.setdefault(r["total"], []).append((r["range_start"], r["range_end"]))
    assert {t: (len(p), max(p)) for t, p in by_total.items()} == {
        1: (1, (0, 0)), 150: (1, (0, 149)), 151: (2, (150, 150)), 4000: (21, (3000, 3149)),
    }
    assert paging.page_ranges(totals, "total", paging.TEST_RESULTS).filter("total = 4000").count() == 2
    assert paging.page_numbers(totals, "total", paging.MAX_RESULTS).groupBy("total").count().filter("total = 4000").first()["count"] == 63
    assert paging.page_numbers(totals, "total", paging.MAX_RESULTS).filter("total is null").count() == 0


def test_search_grid(spark):
    departments = spark.createDataFrame([("01",), ("02",)], "code string")
    assert paging.search_grid(departments, ["data", "bi"]).count() == 4
