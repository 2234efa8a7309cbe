"""Scalar cleaning and typing, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobscape.functions import figures, text as tx
from jobscape.operators.flatten import all_text, flatten_record, normalize_columns
from workload.tables import money, table, text

NBSP = "\N{NO-BREAK SPACE}"


def null_if_blank(spark, sf):
    padded = F.when(F.col("c_acctbal") < 0, "   ").otherwise(F.concat(F.lit("  "), "c_name", F.lit(" ")))
    return table(spark, sf, "customer").select("c_custkey", tx.null_if_blank(padded).alias("name"))


def not_blank(spark, sf):
    """Lines with content per document; counted inside the row, so nothing is shuffled."""
    lines = F.filter(F.split("text", "\n"), lambda line: tx.is_not_blank(line))
    d = table(spark, sf, "documents").select("doc_id", F.size(lines).cast("bigint").alias("n_lines"))
    return d.filter("n_lines > 0")


def safe_cast(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        tx.to_whole_number(F.concat(F.lit(" "), F.right("c_name", F.lit(9)), F.lit(" "))).alias("from_digits"),
        tx.to_whole_number("c_name").alias("from_text"),
        tx.to_whole_number(money("c_acctbal")).alias("from_amount"),
        tx.to_whole_number(F.lit(" ")).alias("from_blank"),
    )


def quality_flags(spark, sf):
    # The text is reduced to its flag first, so that it stays out of the join.
    d = table(spark, sf, "documents").select("doc_id", tx.keyword_flag("text", "the").alias("has_word"))
    return d.join(table(spark, sf, "labels"), "doc_id", "left").select(
        "doc_id",
        tx.presence_flag("quality").alias("has_label"),
        tx.presence_flag("quality", "toxic").alias("has_any"),
        "has_word",
    )


def area_tokens(spark, sf):
    words = F.split("p_name", " ")
    area = F.when(F.col("p_size") > 40, F.array("p_name")).when(F.col("p_size") > 20, words).otherwise(
        F.array_append(words, F.col("p_brand"))
    )
    p = table(spark, sf, "part").select("p_partkey", area.alias("area"))
    return p.select("p_partkey", tx.area_city("area").alias("city"), tx.area_department("area").alias("department"))


def label_tokens(spark, sf):
    label = F.when(F.col("p_size") > 25, F.col("p_name")).otherwise(
        F.concat(F.lit(" "), "p_brand", F.lit(" , "), "p_name", F.lit(", "), "p_type")
    )
    p = table(spark, sf, "part").select("p_partkey", label.alias("label"))
    return p.select("p_partkey", tx.label_city("label").alias("city"), tx.label_department("label").alias("department"))


def first_code(spark, sf):
    from jobscape.operators.geo import first_code as first

    words = F.when(F.col("p_size") > 40, F.array().cast("array<string>")).otherwise(F.split("p_name", " "))
    p = table(spark, sf, "part").select("p_partkey", words.alias("codes"), F.to_json(words).alias("as_json"))
    return p.select("p_partkey", first("codes").alias("first"), first("as_json", as_json=True).alias("first_json"))


def nested_orders(spark, sf):
    detail = F.struct(
        F.col("o_orderstatus").alias("status"),
        F.struct(F.col("o_orderpriority").alias("level")).alias("priority"),
        F.array("o_orderstatus", "o_orderpriority").alias("tags"),
    )
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), detail.alias("detail"))


def nested_fields(spark, sf):
    return nested_orders(spark, sf).select(
        "id", F.col("detail.status").alias("status"), F.col("detail.priority.level").alias("level")
    )


def flatten_all(spark, sf):
    return flatten_record(nested_orders(spark, sf))


def flatten_one_level(spark, sf):
    return flatten_record(nested_orders(spark, sf), max_depth=1, keep_parent=True, null_as="")


def mixed_rows(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return d.select(
        "doc_id", "quality", (F.col("n_chars") > 1000).alias("is_long"), F.array("lang", "source").alias("origin")
    )


def as_text(spark, sf):
    return all_text(mixed_rows(spark, sf))


def normalize_value(spark, sf):
    return normalize_columns(mixed_rows(spark, sf))


def iso_timestamp(spark, sf):
    shown = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    stamp = F.when(F.col("event_type") == "error", shown).otherwise(F.concat(shown, F.lit("Z")))
    return table(spark, sf, "events").select(
        "event_id", tx.is_iso_timestamp(stamp).alias("stamp_ok"), tx.is_iso_timestamp("props").alias("props_ok")
    )


def example_text(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        tx.example_text("text", 120).alias("sample"),
        tx.example_text("text", 200, dots=False).alias("sample_200"),
    )


def strip_invisible(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.md5(tx.strip_invisible("text")).alias("clean_md5"))


def range_total(spark, sf):
    total = text("o_custkey")
    header = F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("offres 0-149/"), total)).when(
        F.col("o_orderstatus") == "F", "offres */x"
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", tx.total_from_range(header, F.col("o_orderkey")).alias("total")
    )


def first_of(spark, sf):
    first = F.when(F.col("o_orderstatus") == "P", "").when(F.col("o_orderstatus") == "O", F.col("o_orderstatus"))
    second = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    return table(spark, sf, "orders").select("o_orderkey", tx.first_of(first, second).alias("label"))


def fr_number(spark, sf):
    plain = F.replace(money("c_acctbal"), F.lit("."), F.lit(","))
    spaced = F.concat(F.substring(plain, 1, 2), F.lit(NBSP), F.substring(plain, 3, 20))
    return table(spark, sf, "customer").select(
        "c_custkey",
        figures.fr_number(spaced).alias("amount"),
        figures.fr_number(F.concat(spaced, F.lit(" %")), percent=True).alias("share"),
        figures.fr_number("c_name").alias("not_a_number"),
    )


def score_cells(spark, sf):
    size = F.col("p_size")
    mark = F.concat(text(size), F.lit("/100"))
    cells = (
        F.when(size > 40, F.array(F.col("p_name"), F.lit("--/100")))
        .when(size < 5, F.array(F.lit(" "), mark))
        .otherwise(F.array(F.lit(""), mark, F.concat(F.lit(" "), "p_name"), F.lit("1/100")))
    )
    p = table(spark, sf, "part").select("p_partkey", figures.score_cells(cells).alias("s"))
    return p.select("p_partkey", F.col("s.label").alias("label"), F.col("s.score").alias("score"))


def split_scores(spark, sf):
    packed = F.when(F.col("p_size") > 40, F.lit(None)).otherwise(
        F.concat(F.substring("p_type", 1, 1), F.lit(";"), F.when(F.col("p_size") > 20, "").otherwise("B"), F.lit(";"), F.right("p_brand", F.lit(1)))
    )
    return table(spark, sf, "part").select("p_partkey", *figures.split_scores(packed))


def suffix_unit(spark, sf):
    score = F.when(F.col("p_size") <= 40, text("p_size"))
    return table(spark, sf, "part").select("p_partkey", figures.suffix_unit(score).alias("carbon"))


def company_name(spark, sf):
    name = F.when(F.col("c_acctbal") > 5000, F.col("c_name")).when(F.col("c_acctbal") > 0, "")
    first = F.when(F.col("c_nationkey") > 12, F.col("c_mktsegment"))
    return table(spark, sf, "customer").select("c_custkey", tx.company_name(name, first, "c_name").alias("name"))


def address_line(spark, sf):
    number = F.when(F.col("c_nationkey") > 12, text("c_nationkey"))
    return table(spark, sf, "customer").select(
        "c_custkey", tx.address_line(number, F.lit("RUE"), "c_mktsegment").alias("address")
    )


def state_label(spark, sf):
    state = F.when(F.col("l_returnflag") != "R", F.col("l_returnflag"))
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_returnflag", tx.state_label(state).alias("state"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def default_text(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return d.select(
        "doc_id",
        tx.default_text(text("quality")).alias("quality"),
        tx.drop_none_words(F.when(F.col("toxic") == 1, "nan").otherwise(text("toxic"))).alias("toxic"),
    )


def span_filters(spark, sf):
    span = F.when(F.col("c_nationkey") > 20, "").when(F.col("c_nationkey") > 12, F.concat(money("c_acctbal"), F.lit(" %"))).otherwise(
        money("c_acctbal")
    )
    c = table(spark, sf, "customer").select("c_custkey", span.alias("span"))
    return c.filter((F.col("span") != "") & figures.starts_numeric("span") & ~figures.has_percent("span"))


QUERIES = {
    "null_if_blank": null_if_blank,
    "not_blank": not_blank,
    "safe_cast": safe_cast,
    "quality_flags": quality_flags,
    "area_tokens": area_tokens,
    "label_tokens": label_tokens,
    "first_code": first_code,
    "nested_fields": nested_fields,
    "flatten_record": flatten_all,
    "flatten_one_level": flatten_one_level,
    "as_text": as_text,
    "normalize_value": normalize_value,
    "iso_timestamp": iso_timestamp,
    "example_text": example_text,
    "strip_invisible": strip_invisible,
    "range_total": range_total,
    "first_of": first_of,
    "fr_number": fr_number,
    "score_cells": score_cells,
    "split_scores": split_scores,
    "suffix_unit": suffix_unit,
    "company_name": company_name,
    "address_line": address_line,
    "state_label": state_label,
    "default_text": default_text,
    "span_filters": span_filters,
}

MONEY = "CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR)"
ESCAPED = r"regexp_replace(replace(text, chr(10), '\n'), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')"

ORACLE = {
    "null_if_blank": "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS name FROM customer",
    "not_blank": """SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines FROM
      (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE trim(line) <> '' GROUP BY doc_id""",
    "safe_cast": """SELECT c_custkey, CAST(right(c_name, 9) AS BIGINT) AS from_digits, CAST(NULL AS BIGINT) AS from_text,
      CAST(NULL AS BIGINT) AS from_amount, CAST(NULL AS BIGINT) AS from_blank FROM customer""",
    "quality_flags": """SELECT d.doc_id, CASE WHEN l.quality IS NULL THEN 0 ELSE 1 END AS has_label,
      CASE WHEN l.quality IS NULL AND l.toxic IS NULL THEN 0 ELSE 1 END AS has_any,
      CASE WHEN upper(d.text) LIKE '%THE%' THEN 1 ELSE 0 END AS has_word
      FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "area_tokens": """SELECT p_partkey,
      CASE WHEN p_size > 40 THEN NULL WHEN p_size > 20 THEN split_part(p_name, ' ', 2) ELSE p_brand END AS city,
      CASE WHEN p_size > 20 THEN NULL ELSE split_part(p_name, ' ', 2) END AS department FROM part""",
    "label_tokens": """SELECT p_partkey, CASE WHEN p_size > 25 THEN p_name ELSE p_brand END AS city,
      CASE WHEN p_size > 25 THEN NULL ELSE p_name || ', ' || p_type END AS department FROM part""",
    "first_code": """SELECT p_partkey, CASE WHEN p_size <= 40 THEN split_part(p_name, ' ', 1) END AS first,
      CASE WHEN p_size <= 40 THEN split_part(p_name, ' ', 1) END AS first_json FROM part""",
    "nested_fields": "SELECT o_orderkey AS id, o_orderstatus AS status, o_orderpriority AS level FROM orders",
    "flatten_record": """SELECT o_orderkey AS id, o_orderstatus AS detail__status, o_orderpriority AS detail__priority__level,
      '["' || o_orderstatus || '","' || o_orderpriority || '"]' AS detail__tags FROM orders""",
    "flatten_one_level": """SELECT CAST(o_orderkey AS VARCHAR) AS id,
      '{"status":"' || o_orderstatus || '","priority":{"level":"' || o_orderpriority || '"},"tags":["' || o_orderstatus
        || '","' || o_orderpriority || '"]}' AS detail,
      o_orderstatus AS detail__status, '{"level":"' || o_orderpriority || '"}' AS detail__priority,
      '["' || o_orderstatus || '","' || o_orderpriority || '"]' AS detail__tags FROM orders""",
    "as_text": """SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, coalesce(CAST(l.quality AS VARCHAR), '') AS quality,
      CASE WHEN d.n_chars > 1000 THEN 'true' ELSE 'false' END AS is_long, '["' || lang || '","' || source || '"]' AS origin
      FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "normalize_value": """SELECT d.doc_id, l.quality, CASE WHEN d.n_chars > 1000 THEN 1 ELSE 0 END AS is_long,
      '["' || lang || '","' || source || '"]' AS origin FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "iso_timestamp": "SELECT event_id, event_type <> 'error' AS stamp_ok, false AS props_ok FROM events",
    "example_text": f"""SELECT doc_id, CASE WHEN length(t) > 120 THEN substring(t, 1, 120) || '...' ELSE t END AS sample,
      substring(t, 1, 200) AS sample_200 FROM (SELECT doc_id, {ESCAPED} AS t FROM documents)""",
    "strip_invisible": r"""SELECT doc_id, md5(regexp_replace(replace(text, chr(160), ' '),
      '[\x{200B}-\x{200F}\x{2028}\x{2029}\x{FEFF}\x{00AD}]', '', 'g')) AS clean_md5 FROM documents""",
    "range_total": "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_custkey ELSE o_orderkey END AS total FROM orders",
    "first_of": """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'O' WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority
      ELSE 'unknown_search' END AS label FROM orders""",
    "fr_number": """SELECT c_custkey, round(c_acctbal, 2) AS amount, round(c_acctbal, 2) AS share, CAST(NULL AS DOUBLE) AS not_a_number
      FROM customer""",
    "score_cells": """SELECT p_partkey, CASE WHEN p_size BETWEEN 5 AND 40 THEN p_name || ' du secteur' END AS label,
      CASE WHEN p_size BETWEEN 5 AND 40 THEN CAST(p_size AS VARCHAR) || '/100' END AS score FROM part""",
    "split_scores": """SELECT p_partkey, CASE WHEN p_size <= 40 THEN left(p_type, 1) END AS territorial,
      CASE WHEN p_size <= 20 THEN 'B' END AS social, CASE WHEN p_size <= 40 THEN right(p_brand, 1) END AS fiscal FROM part""",
    "suffix_unit": "SELECT p_partkey, CASE WHEN p_size <= 40 THEN CAST(p_size AS VARCHAR) ELSE '' END || ' tCO2e' AS carbon FROM part",
    "company_name": """SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN c_name WHEN c_nationkey > 12 THEN c_mktsegment || ' ' || c_name
      ELSE c_name END AS name FROM customer""",
    "address_line": """SELECT c_custkey, CASE WHEN c_nationkey > 12 THEN CAST(c_nationkey AS VARCHAR) || ' ' ELSE '' END
      || 'RUE ' || c_mktsegment AS address FROM customer""",
    "state_label": """SELECT l_returnflag, CASE WHEN l_returnflag = 'A' THEN 'Actif' ELSE 'Fermé' END AS state,
      CAST(count(*) AS BIGINT) AS n_rows FROM lineitem GROUP BY 1, 2""",
    "default_text": """SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), 'Non renseigné') AS quality,
      CASE WHEN l.toxic = 1 OR l.toxic IS NULL THEN '' ELSE CAST(l.toxic AS VARCHAR) END AS toxic
      FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "span_filters": f"""SELECT c_custkey, {MONEY} AS span FROM customer
      WHERE c_nationkey <= 12 AND regexp_matches({MONEY}, '^[1-9]')""",
}
