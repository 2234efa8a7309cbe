"""Repeated fetches: first and last per key, counters, caps and page plans."""

from __future__ import annotations

import json
import time

from pyspark.sql import Window, functions as F

from jobscape.operators import dedupe, paging, reports
from jobscape.session import scratch_path
from jobscape.sources import paged
from workload.tables import table

KEY = ["l_orderkey", "l_linenumber"]
# A total order of the fetches of one key.
ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select(*KEY, *ORDER)


def _shown(df):
    return df.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


def dedupe_first(spark, sf):
    return _shown(dedupe.keep_first(_lines(spark, sf), KEY, ORDER))


def upsert_last(spark, sf):
    """Lines shipped late are merged into the earlier ones."""
    lines = _lines(spark, sf)
    late = F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp")
    stored = dedupe.keep_first(lines.filter(~late), KEY, ORDER)
    return _shown(dedupe.upsert(stored, lines.filter(late), KEY, ORDER))


def dedupe_counters(spark, sf):
    """Line numbers as searches, in order, that each return orders; the other searches find nothing."""
    fetched = table(spark, sf, "lineitem").select(
        F.col("l_linenumber").alias("rank"), F.col("l_orderkey").alias("id")
    )
    searches = table(spark, sf, "nation").select(
        F.col("n_name").alias("search"), F.col("n_nationkey").cast("int").alias("rank")
    )
    return dedupe.extraction_counters(fetched, searches, "search", "rank", "id")


def cap_per_group(spark, sf):
    """The newest 3150 lines of every return flag."""
    lines = table(spark, sf, "lineitem").select("l_returnflag", *KEY, *ORDER)
    return _shown(dedupe.cap_per_search(lines, "l_returnflag", "l_shipdate", [*KEY, *ORDER[1:]], paging.MAX_RESULTS))


def cap_test_mode(spark, sf):
    """The newest 200 orders per status and priority."""
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority", "o_orderkey", "o_orderdate")
    capped = dedupe.cap_per_search(
        orders, ["o_orderstatus", "o_orderpriority"], "o_orderdate", ["o_orderkey"], paging.TEST_RESULTS
    )
    return capped.drop("o_orderdate")


def _totals(spark, sf):
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return c.join(counts, c.c_custkey == counts.o_custkey, "left").na.fill(0, ["n"])


def page_plan(spark, sf):
    per_nation = _totals(spark, sf).groupBy("c_nationkey").agg(F.sum("n").alias("total"))
    return paging.page_ranges(per_nation, "total", paging.MAX_RESULTS)


def page_plan_small(spark, sf):
    """Pages of four, at most ten results, per customer; customers without orders, or of unknown total, need none."""
    # Of some customers the total is not known.
    total = F.when(F.col("c_custkey") % 7 != 0, F.col("n"))
    per_customer = _totals(spark, sf).select("c_custkey", total.alias("total"))
    return paging.page_ranges(per_customer, "total", size=4, cap=10)


def page_numbers(spark, sf):
    per_segment = _totals(spark, sf).groupBy("c_mktsegment").agg(F.sum("n").alias("total"))
    return paging.page_numbers(per_segment, "total", paging.MAX_RESULTS)


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "SPACE")


def search_grid(spark, sf):
    """Every segment searched in every nation, its number of orders, and whether it still
    passes a cap of 200."""
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    grid = paging.search_grid(nations, SEGMENTS, "segment")
    totals = (
        _totals(spark, sf)
        .groupBy(F.col("c_nationkey").alias("n_nationkey"), F.col("c_mktsegment").alias("segment"))
        .agg(F.sum("n").alias("total"))
    )
    joined = grid.join(totals, ["n_nationkey", "segment"], "left").na.fill(0, ["total"])
    return joined.withColumn("over_cap", F.col("total") > paging.TEST_RESULTS)


PAGE = 10
# Pages of a search that lie in one file: what a fetch reads does not grow with the search.
FILED = 64


def _service(spark, sf):
    """A service over the customers: files of some pages of each nation and segment; a page that is not there is empty."""
    place = Window.partitionBy("c_nationkey", "c_mktsegment").orderBy("c_custkey")
    found = table(spark, sf, "customer").withColumn("n", F.row_number().over(place) - 1).groupBy(
        F.concat_ws("-", "c_nationkey", "c_mktsegment").alias("search"), F.floor(F.col("n") / PAGE).alias("page")
    ).agg(F.sort_array(F.collect_list(F.struct("n", F.col("c_custkey").alias("id")))).alias("records"))
    folder = scratch_path(spark, "service")
    pages = found.select("search", (F.col("page") + 1).alias("page"), F.floor(F.col("page") / FILED).alias("file"), F.to_json("records").alias("value"))
    pages.repartition("search", "file").write.partitionBy("search", "file").parquet(folder)

    def fetch(request, page):
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
        files = [f.path for f in store.get_file_info(fs.FileSelector(f"{root}/search={request['search']}/file={(page - 1) // FILED}", allow_not_found=True)) if f.is_file]
        for path in files:
            if path.endswith(".parquet"):
                for row in pq.read_table(path, filesystem=store, partitioning=None, filters=[("page", "=", page)]).to_pylist():
                    return json.loads(row["value"])
        return []

    return [(f"{nation}-{segment}", {"search": f"{nation}-{segment}"}) for nation in range(25) for segment in SEGMENTS], fetch


def _fetched(rows):
    number = F.get_json_object("raw_json", "$.id").cast("bigint")
    return rows.select("search", "page", "pos", number.alias("c_custkey"))


def open_searches(spark, sf):
    """All pages of every search, read until one is short; no total is known."""
    searches, fetch = _service(spark, sf)
    return _fetched(paged.read_searches(spark, searches, fetch, PAGE))


def open_search_stream(spark, sf):
    """The same as a stream, two pages of each search a round, stopped after the first round and started again."""
    searches, fetch = _service(spark, sf)
    progress, target, checkpoint = (scratch_path(spark, n) for n in ("progress", "found", "state"))
    for first in (True, False):
        stream = paged.stream_searches(spark, searches, fetch, PAGE, progress, pages_per_round=2)
        query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).start(target)
        while first and not query.recentProgress and not query.exception():
            time.sleep(0.1)
        if not first:
            query.processAllAvailable()
        query.stop()
    return _fetched(spark.read.parquet(target))


def latest_batch(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    return reports.latest_batch(orders, "o_orderdate").drop("o_orderdate")


QUERIES = {
    "dedupe_first": dedupe_first,
    "upsert_last": upsert_last,
    "dedupe_counters": dedupe_counters,
    "cap_per_group": cap_per_group,
    "cap_per_group_test_mode": cap_test_mode,
    "page_plan": page_plan,
    "page_plan_small": page_plan_small,
    "page_numbers": page_numbers,
    "search_grid": search_grid,
    "open_searches": open_searches,
    "open_search_stream": open_search_stream,
    "latest_batch": latest_batch,
}

COLS = ", ".join(KEY + ORDER)
SHOWN = COLS.replace("l_shipdate", "strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate")
ASC = ", ".join(ORDER)
DESC = ", ".join(f"{c} DESC" for c in ORDER)
TOTALS = """totals AS (SELECT c_custkey, c_nationkey, c_mktsegment, CAST(count(o_orderkey) AS BIGINT) AS n
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2, 3)"""


def _ranges(source: str, key: str, size: int, cap: int) -> str:
    return f"""SELECT {key}, total, range_start, least(range_start + {size} - 1, least(total, {cap}) - 1) AS range_end FROM
      (SELECT {key}, total, unnest(range(0, least(total, {cap}), {size})) AS range_start FROM {source})"""


FOUND = f"""SELECT search, CAST((n - 1) // {PAGE} + 1 AS INT) AS page, CAST((n - 1) % {PAGE} AS INT) AS pos, c_custkey FROM
  (SELECT c_nationkey || '-' || c_mktsegment AS search, c_custkey,
     row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS n FROM customer)"""

ORACLE = {
    "open_searches": FOUND,
    "open_search_stream": FOUND,
    "dedupe_first": f"""SELECT {SHOWN} FROM (SELECT {COLS}, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {ASC}) AS rn
      FROM lineitem) WHERE rn = 1""",
    "upsert_last": f"""WITH ranked AS (
        SELECT {COLS}, 0 AS fresh, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {ASC}) AS rn
        FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'
        UNION ALL SELECT {COLS}, 1, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {DESC})
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'),
      best AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY fresh DESC) AS k FROM ranked WHERE rn = 1)
      SELECT {SHOWN} FROM best WHERE k = 1""",
    "dedupe_counters": """WITH f AS (SELECT l_linenumber AS rank, count(*) AS fetched FROM lineitem GROUP BY 1),
      firsts AS (SELECT rank, count(*) AS added FROM (SELECT l_orderkey, min(l_linenumber) AS rank FROM lineitem GROUP BY 1) GROUP BY 1),
      s AS (SELECT n_name AS search, coalesce(fetched, 0) AS fetched, coalesce(added, 0) AS added FROM nation
        LEFT JOIN f ON f.rank = n_nationkey LEFT JOIN firsts ON firsts.rank = n_nationkey)
      SELECT search, CAST(sum(fetched) AS BIGINT) AS fetched, CAST(sum(added) AS BIGINT) AS added,
        CAST(sum(fetched) - sum(added) AS BIGINT) AS duplicates FROM s GROUP BY ROLLUP (search)""",
    "cap_per_group": f"""SELECT l_returnflag, {SHOWN} FROM (SELECT l_returnflag, {COLS}, row_number() OVER (PARTITION BY l_returnflag
        ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, {", ".join(ORDER[1:])}) AS rn FROM lineitem) WHERE rn <= 3150""",
    "cap_per_group_test_mode": """SELECT o_orderstatus, o_orderpriority, o_orderkey FROM (SELECT *, row_number() OVER
      (PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 200""",
    "page_plan": f"""WITH {TOTALS}, p AS (SELECT c_nationkey, CAST(sum(n) AS BIGINT) AS total FROM totals GROUP BY 1)
      {_ranges("p", "c_nationkey", 150, 3150)}""",
    "page_plan_small": f"WITH {TOTALS}, p AS (SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN n END AS total FROM totals WHERE c_custkey % 7 <> 0) {_ranges('p', 'c_custkey', 4, 10)}",
    "page_numbers": f"""WITH {TOTALS}, p AS (SELECT c_mktsegment, CAST(sum(n) AS BIGINT) AS total FROM totals GROUP BY 1)
      SELECT c_mktsegment, total, unnest(range(1, CAST(ceil(least(total, 3150) / 50.0) AS BIGINT) + 1)) AS page FROM p""",
    "search_grid": f"""WITH {TOTALS}, g AS (SELECT n_nationkey, n_name, unnest({list(SEGMENTS)}) AS segment FROM nation),
      t AS (SELECT c_nationkey, c_mktsegment, CAST(sum(n) AS BIGINT) AS total FROM totals GROUP BY 1, 2)
      SELECT g.n_nationkey, g.n_name, g.segment, coalesce(t.total, 0) AS total, coalesce(t.total, 0) > 200 AS over_cap
      FROM g LEFT JOIN t ON t.c_nationkey = g.n_nationkey AND t.c_mktsegment = g.segment""",
    "latest_batch": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)",
}
