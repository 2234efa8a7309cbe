"""Field profiles of JSON records and the coverage of reference lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobscape.operators import profile
from workload.tables import table


RECORD_HINTS = {
    "contrat.code": ("ref_line", "l_linestatus"),
    "langues[].libelle": ("ref_nation", "n_name"),
    "id": ("ref_customer", "c_custkey"),
    "contrat.label": ("ref_line", "no_such_key"),
    "contrat.unseen": ("ref_line", "l_linestatus"),
}


def _records(spark, sf):
    """Orders as nested JSON: an absent key, a null, a list of records, two number types."""
    status = F.col("o_orderstatus")
    record = F.struct(
        F.col("o_orderkey").alias("id"),
        F.struct(status.alias("code"), F.when(status != "P", F.col("o_orderpriority")).alias("label")).alias("contrat"),
        F.array(
            F.struct(F.lit("fr").alias("libelle")), F.struct(F.when(status == "F", "en").otherwise("de").alias("libelle"))
        ).alias("langues"),
        F.when(status == "O", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("date"),
        (F.col("o_totalprice") > 100000).alias("riche"),
    )
    with_null = F.to_json(record, {"ignoreNullFields": "false"})
    without = F.to_json(record)
    chosen = F.when(F.col("o_orderpriority") == "5-LOW", without).otherwise(with_null)
    return table(spark, sf, "orders").select("o_orderkey", chosen.alias("raw_json"))


def _flat(df):
    return df.withColumns(
        {"observed_types": F.array_join("observed_types", ","), "examples": F.array_join("examples", "|")}
    )


def json_profile(spark, sf):
    return _flat(profile.json_field_profile(table(spark, sf, "events"), "props", ["event_id"]))


def json_profile_nested(spark, sf):
    return _flat(profile.json_field_profile(_records(spark, sf), "raw_json", ["o_orderkey"]))


def json_profile_referentials(spark, sf):
    """The nested profile with reference lists beside: line statuses, nation names, customer keys."""
    lists = (
        profile.referential_values(table(spark, sf, "lineitem"), "ref_line", ["l_linestatus"])
        .unionByName(profile.referential_values(table(spark, sf, "nation"), "ref_nation", ["n_name"]))
        .unionByName(profile.referential_values(table(spark, sf, "customer"), "ref_customer", ["c_custkey"]))
    )
    return _flat(
        profile.json_field_profile(_records(spark, sf), "raw_json", ["o_orderkey"], referentials=lists, hints=RECORD_HINTS)
    )


def field_catalog(spark, sf):
    return profile.field_catalog(_records(spark, sf), "raw_json", ["o_orderkey"])


def observed_keys(spark, sf):
    return profile.observed_keys(_records(spark, sf), "raw_json")


def observed_values(spark, sf):
    return profile.observed_values(_records(spark, sf), "raw_json", ["contrat.label", "langues[].libelle", "riche", "contrat"])


def distinct_counts(spark, sf):
    return profile.distinct_counts(_records(spark, sf), "raw_json", ["id", "contrat.label", "langues[].libelle", "date"])


def _lists(spark, sf):
    lists = [
        profile.referential_values(table(spark, sf, "nation"), "ref_nation", ["n_nationkey", "n_name"]),
        profile.referential_values(table(spark, sf, "region"), "ref_region", ["r_regionkey", "r_name"]),
        profile.referential_values(table(spark, sf, "part"), "ref_part", ["p_brand", "p_type", "p_size"]),
    ]
    out = lists[0]
    for part in lists[1:]:
        out = out.unionByName(part)
    return out


def referential_values(spark, sf):
    return _lists(spark, sf)


HINTS = {
    "c_nationkey": ("ref_nation", "n_nationkey"),
    "c_mktsegment": ("ref_part", "p_type"),
    "n_regionkey": ("ref_region", "r_regionkey"),
    "unseen": ("ref_part", "p_brand"),
    "size": ("ref_nation", "n_nationkey"),
    "unlisted": ("ref_part", "no_such_key"),
}


def referential_coverage(spark, sf):
    c = profile.column_values(table(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"])
    n = profile.column_values(table(spark, sf, "nation"), ["n_regionkey"])
    p = profile.column_values(
        table(spark, sf, "part").select(F.col("p_size").alias("size"), F.col("p_size").alias("unlisted")), ["size", "unlisted"]
    )
    return profile.referential_coverage(c.unionByName(n).unionByName(p), _lists(spark, sf), HINTS)


QUERIES = {
    "json_profile": json_profile,
    "json_profile_nested": json_profile_nested,
    "json_profile_referentials": json_profile_referentials,
    "field_catalog": field_catalog,
    "observed_keys": observed_keys,
    "observed_values": observed_values,
    "distinct_counts": distinct_counts,
    "referential_values": referential_values,
    "referential_coverage": referential_coverage,
}


def _row(path: str, present: str, filled: str, types: str, kind: str, values: str | None, times: int = 1) -> str:
    """One profile line: conditions for presence and value, and the value as text."""
    if values is None:
        examples = "''"
    else:
        examples = f"""(SELECT coalesce(string_agg(v, '|' ORDER BY o), '') FROM (SELECT v, min(o) AS o FROM
          (SELECT {values} AS v, k AS o FROM r WHERE ({filled}) AND {values} IS NOT NULL) GROUP BY v ORDER BY o LIMIT 3))"""
    return f"""SELECT '{path}' AS field_path, CAST(count(*) FILTER ({present}) * {times} AS BIGINT) AS presence_count,
      CAST(count(*) FILTER ({filled}) * {times} AS BIGINT) AS non_null_count,
      round(count(*) FILTER ({present}) * {times} * 100.0 / count(*), 2) AS presence_rate_pct,
      '{types}' AS observed_types, '{kind}' AS suggested_type, {examples} AS examples FROM r"""


RECORDS = "r AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_orderpriority AS p, o_totalprice AS t, o_orderdate AS d FROM orders)"
DATE = "strftime(d, '%Y-%m-%dT%H:%M:%SZ')"
RICH = "CASE WHEN t > 100000 THEN 'true' ELSE 'false' END"
LABEL_SEEN, DATE_SEEN = "s <> 'P' OR p <> '5-LOW'", "s = 'O' OR p <> '5-LOW'"
# The second list element alternates by status; the first is always fr.
LANGUAGES = """(SELECT string_agg(v, '|' ORDER BY o, i) FROM (SELECT v, min(o) AS o, min(i) AS i FROM
  (SELECT 'fr' AS v, k AS o, 0 AS i FROM r UNION ALL SELECT CASE WHEN s = 'F' THEN 'en' ELSE 'de' END, k, 1 FROM r) GROUP BY v))"""

PROFILE_ROWS = [
    _row("id", "true", "true", "int", "INT64", "CAST(k AS VARCHAR)"),
    _row("contrat", "true", "true", "dict", "JSON", None),
    _row("contrat.code", "true", "true", "str", "STRING", "s"),
    _row("contrat.label", LABEL_SEEN, "s <> 'P'", "null,str", "STRING", "p"),
    _row("langues", "true", "true", "list", "JSON", None),
    _row("langues[]", "true", "true", "dict", "JSON", None, 2),
    _row("langues[].libelle", "true", "true", "str", "STRING", None, 2).replace("'' AS examples", f"{LANGUAGES} AS examples"),
    _row("date", DATE_SEEN, "s = 'O'", "null,timestamp_str", "TIMESTAMP", DATE),
    _row("riche", "true", "true", "bool", "BOOL", RICH),
]


def _catalog(path: str, kind: str, present: str, value: str, filled: str) -> str:
    column = path.replace(".", "__")
    return f"""SELECT '{path}' AS field_path, '{column}' AS column_name, '{kind}' AS column_type,
      CAST(count(*) FILTER ({present}) AS BIGINT) AS presence_count, min_by({value}, k) FILTER ({filled}) AS example_value FROM r"""


COVERED = """SELECT 'contrat.code' AS field_path, 'ref_line.l_linestatus' AS referential,
    round(count(*) FILTER (s IN (SELECT l_linestatus FROM lineitem)) * 100.0 / count(*), 2) AS coverage_pct FROM (SELECT DISTINCT s FROM r)
  UNION ALL SELECT 'langues[].libelle', 'ref_nation.n_name', 0.0
  UNION ALL SELECT 'id', 'ref_customer.c_custkey', round(count(*) FILTER (k IN (SELECT c_custkey FROM customer)) * 100.0 / count(*), 2)
    FROM (SELECT DISTINCT k FROM r)
  UNION ALL SELECT 'contrat.label', 'ref_line.no_such_key', NULL"""


ORACLE = {
    "json_profile_referentials": f"""WITH {RECORDS}, p AS ({" UNION ALL ".join(PROFILE_ROWS)}), c AS ({COVERED})
      SELECT * FROM p LEFT JOIN c USING (field_path)""",
    "json_profile": """WITH e AS (SELECT event_id, json_extract_string(props, '$.k') AS v FROM events),
      x AS (SELECT string_agg(v, '|' ORDER BY o) AS examples FROM (SELECT v, min(event_id) AS o FROM e GROUP BY v ORDER BY o LIMIT 3))
      SELECT 'k' AS field_path, CAST(count(*) AS BIGINT) AS presence_count, CAST(count(v) AS BIGINT) AS non_null_count,
        100.0::DOUBLE AS presence_rate_pct, 'int' AS observed_types, 'INT64' AS suggested_type, any_value(examples) AS examples FROM e, x""",
    "json_profile_nested": f"WITH {RECORDS} " + " UNION ALL ".join(PROFILE_ROWS),
    "field_catalog": f"WITH {RECORDS} " + " UNION ALL ".join([
        _catalog("id", "INTEGER", "true", "CAST(k AS VARCHAR)", "true"),
        _catalog("contrat.code", "TEXT", "true", "s", "true"),
        _catalog("contrat.label", "TEXT", LABEL_SEEN, "p", "s <> 'P'"),
        _catalog("langues", "TEXT", "true", """'[{"libelle": "fr"}, {"libelle": "' || CASE WHEN s = 'F' THEN 'en' ELSE 'de' END || '"}]'""", "true"),
        _catalog("date", "TEXT", DATE_SEEN, DATE, "s = 'O'"),
        _catalog("riche", "INTEGER", "true", RICH, "true"),
    ]),
    "observed_keys": "SELECT unnest(['id', 'contrat', 'langues', 'date', 'riche']) AS key WHERE (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') > 0",
    "observed_values": """SELECT DISTINCT 'contrat.label' AS field_path, o_orderpriority AS value FROM orders WHERE o_orderstatus <> 'P'
      UNION SELECT 'langues[].libelle', 'fr' FROM orders UNION SELECT 'langues[].libelle', CASE WHEN o_orderstatus = 'F' THEN 'en' ELSE 'de' END FROM orders
      UNION SELECT 'riche', CASE WHEN o_totalprice > 100000 THEN 'true' ELSE 'false' END FROM orders""",
    "distinct_counts": """SELECT 'id' AS field_path, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS n_values FROM orders
      UNION ALL SELECT 'contrat.label', CAST(count(DISTINCT o_orderpriority) AS BIGINT) FROM orders WHERE o_orderstatus <> 'P'
      UNION ALL SELECT 'langues[].libelle', CAST(count(DISTINCT v) AS BIGINT) FROM
        (SELECT 'fr' AS v FROM orders UNION ALL SELECT CASE WHEN o_orderstatus = 'F' THEN 'en' ELSE 'de' END FROM orders)
      UNION ALL SELECT 'date', CAST(count(DISTINCT o_orderdate) AS BIGINT) FROM orders WHERE o_orderstatus = 'O'""",
    "referential_values": """SELECT 'ref_nation' AS referential, 'n_nationkey' AS key, CAST(n_nationkey AS VARCHAR) AS value FROM nation
      UNION SELECT 'ref_nation', 'n_name', n_name FROM nation UNION SELECT 'ref_region', 'r_regionkey', CAST(r_regionkey AS VARCHAR) FROM region
      UNION SELECT 'ref_region', 'r_name', r_name FROM region UNION SELECT 'ref_part', 'p_brand', p_brand FROM part
      UNION SELECT 'ref_part', 'p_type', p_type FROM part UNION SELECT 'ref_part', 'p_size', CAST(p_size AS VARCHAR) FROM part""",
    "referential_coverage": """WITH o AS (SELECT DISTINCT 'c_nationkey' AS f, CAST(c_nationkey AS VARCHAR) AS v FROM customer
        UNION SELECT 'c_mktsegment', c_mktsegment FROM customer UNION SELECT 'n_regionkey', CAST(n_regionkey AS VARCHAR) FROM nation
        UNION SELECT 'size', CAST(p_size AS VARCHAR) FROM part UNION SELECT 'unlisted', CAST(p_size AS VARCHAR) FROM part),
      h AS (SELECT * FROM (VALUES ('c_nationkey', 'ref_nation.n_nationkey'), ('c_mktsegment', 'ref_part.p_type'),
        ('n_regionkey', 'ref_region.r_regionkey'), ('unseen', 'ref_part.p_brand'), ('size', 'ref_nation.n_nationkey'),
        ('unlisted', 'ref_part.no_such_key')) t(f, l)),
      k AS (SELECT DISTINCT 'ref_nation.n_nationkey' AS l, CAST(n_nationkey AS VARCHAR) AS v FROM nation
        UNION SELECT 'ref_part.p_type', p_type FROM part UNION SELECT 'ref_region.r_regionkey', CAST(r_regionkey AS VARCHAR) FROM region
        UNION SELECT 'ref_part.p_brand', p_brand FROM part)
      SELECT h.f AS field_path, h.l AS referential, CAST(count(o.v) AS BIGINT) AS n_values, CAST(count(k.v) AS BIGINT) AS n_matched,
        CASE WHEN count(o.v) > 0 AND max(x.n) > 0 THEN round(count(k.v) * 100.0 / count(o.v), 2) END AS coverage_pct
      FROM h LEFT JOIN o ON o.f = h.f LEFT JOIN k ON k.l = h.l AND k.v = o.v
      LEFT JOIN (SELECT l, count(*) AS n FROM k GROUP BY 1) x ON x.l = h.l GROUP BY 1, 2""",
}
