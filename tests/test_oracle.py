"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import math
import re
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__
from workload.tables import coded_offers

SF_DIR = "/root/testdata/sf0.001"
# What a query could change for the queries after it.
SETTINGS = (
    "spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold",
    "spark.sql.optimizer.windowGroupLimitThreshold", "spark.sql.files.maxPartitionBytes",
)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, (float, Decimal)):
        return "NaN" if math.isnan(value) else repr(round(float(value), 6) + 0.0)
    return str(value)


def normal(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    before = {s: spark.conf.get(s) for s in SETTINGS}
    df = __spark_entry__.queries()[name](spark, SF_DIR)
    result = duck.execute(__spark_entry__.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert normal(df.columns, df.collect()) == normal(columns, result.fetchall())
    assert {s: spark.conf.get(s) for s in SETTINGS} == before


def test_every_query_has_sql():
    """Operators of the text pipeline that SQL cannot express have tests of their own."""
    without = set(__spark_entry__.queries()) - set(__spark_entry__.oracle_sql())
    assert all(name == "pipeline" or re.match(r"op\d+_", name) for name in without)


def test_filters_reach_the_scan(spark):
    offers = coded_offers(spark, SF_DIR).filter("typeContrat = 'CDI' and dateCreation > '1995-01-01'")
    text = offers._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(l_shipdate", text) and "Exchange" not in text


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["nom_region", "n_rows", "n_salary", "n_apprentice"]
