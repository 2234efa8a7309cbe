"""Sources and sinks: the given tables are written to the shared folder and read back."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from jobscape.operators.reports import completion_report
from jobscape.plans.staging import raw_offers
from jobscape.session import scratch_path
from jobscape.sinks.files import write_csv_report, write_json_list, write_ndjson
from jobscape.sinks.tables import create_view, upsert_path
from jobscape.sources import files
from workload.tables import table, text

EVENT = "event_id bigint, user_id bigint, event_type string, value double"


def _written(spark, sf, label):
    """Events as line files, one JSON object per line."""
    path = scratch_path(spark, label)
    write_ndjson(table(spark, sf, "events").drop("ts"), path)
    return path


def ndjson_roundtrip(spark, sf):
    """The layout leaves out a key the lines hold: it is dropped."""
    return files.read_ndjson(spark, _written(spark, sf, "ndjson"), EVENT)


def ndjson_strict(spark, sf):
    """Read with unknown keys rejected; all keys are known."""
    return files.read_ndjson(spark, _written(spark, sf, "strict"), f"{EVENT}, props string", unknown="reject")


def _broken(spark, sf):
    """Event lines; those of errors are cut off in the middle."""
    path = scratch_path(spark, "broken")
    line = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    cut = F.when(F.col("event_type") == "error", F.substring(line, F.lit(1), F.length(line) - 5)).otherwise(line)
    table(spark, sf, "events").select(cut.alias("value")).write.text(path)
    return files.read_ndjson_split(spark, path, EVENT)


def lines_read(spark, sf):
    return _broken(spark, sf)[0]


def lines_rejected(spark, sf):
    return _broken(spark, sf)[1].select(F.regexp_extract("raw_json", r'"event_id":(\d+)', 1).cast("bigint").alias("event_id"))


def raw_with_lineage(spark, sf):
    lines = files.raw_lines(spark, _written(spark, sf, "lineage"))
    raw = raw_offers(files.raw_with_lineage(lines, key="event_id"), "run-1", "2026-04-06 07:00:00", "events")
    # Part file names change from run to run; the rest does not.
    return raw.select(
        "offer_id", F.get_json_object("raw_json", "$.event_type").alias("event_type"), "run_id", "source_system",
        F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm").alias("ingested"),
        F.col("source_file").endswith(".json").alias("has_file"),
    )


def wrapped_results(spark, sf):
    """Orders as documents that wrap their offer in a list, next to an item that is none."""
    path = scratch_path(spark, "wrapped")
    offer = F.to_json(F.struct(text("o_orderkey").alias("id"), F.col("o_orderstatus").alias("typeContrat")))
    document = F.concat(F.lit('{"metadata": 1, "resultats": ["x", '), offer, F.lit("]}"))
    table(spark, sf, "orders").select(document.alias("value")).write.text(path)
    documents = spark.read.text(path).select(F.lit("f").alias("source_file"), "value")
    return files.parse_records(files.unwrap_results(documents), "id string, typeContrat string")


def wrapped_results_split(spark, sf):
    """All orders in one document that wraps their list, between lists under other keys, read in blocks of 64 KB."""
    path = scratch_path(spark, "wrapped-split")
    brace = F.concat(F.lit("{[\"}, \\"), F.col("o_orderpriority"))
    offer = F.to_json(F.struct(text("o_orderkey").alias("id"), F.col("o_orderstatus").alias("typeContrat"), brace.alias("intitule")))
    rows = table(spark, sf, "orders").select(offer.alias("value")).coalesce(1)

    def wrapped(batches):
        mark = '{"filtres": [{"id": "no", "resultats": [{"id": "no"}]}], "resultats": [7, '
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"value": [(mark if not i else ", ") + t for i, t in enumerate(batch.column(0).to_pylist())]})
            mark = ", "
        yield pa.RecordBatch.from_pydict({"value": ['], "suite": [{"id": "no"}]}']})

    rows.mapInArrow(wrapped, "value string").write.text(path)
    found = files.read_wrapped(spark, path, block_bytes=1 << 16)
    return files.parse_records(found, "id string, typeContrat string, intitule string")


def json_list(spark, sf):
    path = scratch_path(spark, "list")
    nations = table(spark, sf, "nation").select(F.col("n_name").alias("nom"), text("n_nationkey").alias("code"))
    write_json_list(nations, path)
    return files.read_json_list(spark, path, "nom string, code string")


def referentials_read(spark, sf):
    """Regions and part types as list files, read as reference values."""
    path = scratch_path(spark, "lists")
    regions = table(spark, sf, "region").select(text("r_regionkey").alias("code"), F.col("r_name").alias("libelle"))
    write_json_list(regions, path)
    values = files.read_referentials(spark, path, pattern="*")
    # Part file names change from run to run.
    return values.select("key", "value")


def checked_lines(spark, sf):
    """Every line read whole and required to be an object of the layout."""
    return files.read_ndjson_checked(spark, _written(spark, sf, "checked"), EVENT)


def csv_report(spark, sf):
    path = scratch_path(spark, "report")
    write_csv_report(completion_report(table(spark, sf, "customer")), path, sep=";")
    report = spark.read.option("header", True).option("sep", ";").schema(
        "column string, non_null_count bigint, null_count bigint, completion_rate double"
    )
    return report.csv(path)


def upsert_table(spark, sf):
    """Customers, with the balance of some set by a second batch, as a new table version."""
    base = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.lit(0).alias("batch"))
    late = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("c_mktsegment"),
        F.col("o_orderkey").alias("batch"),
    )
    merged = upsert_path(base.withColumn("batch", F.col("batch").cast("bigint")), late, "c_custkey", ["batch"], scratch_path(spark, "upsert"))
    return merged


def view_rows(spark, sf):
    create_view(table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")), "nation_regions")
    return spark.table("nation_regions").select("n_name", "r_name")


QUERIES = {
    "ndjson_roundtrip": ndjson_roundtrip,
    "ndjson_strict": ndjson_strict,
    "lines_read": lines_read,
    "lines_rejected": lines_rejected,
    "raw_with_lineage": raw_with_lineage,
    "wrapped_results": wrapped_results,
    "wrapped_results_split": wrapped_results_split,
    "json_list": json_list,
    "referentials_read": referentials_read,
    "checked_lines": checked_lines,
    "csv_report": csv_report,
    "upsert_table": upsert_table,
    "view_rows": view_rows,
}

ORACLE = {
    "ndjson_roundtrip": "SELECT event_id, user_id, event_type, value FROM events",
    "ndjson_strict": "SELECT event_id, user_id, event_type, value, props FROM events",
    "lines_read": "SELECT event_id, user_id, event_type, value FROM events WHERE event_type <> 'error'",
    "lines_rejected": "SELECT event_id FROM events WHERE event_type = 'error'",
    "raw_with_lineage": """SELECT CAST(event_id AS VARCHAR) AS offer_id, event_type, 'run-1' AS run_id, 'events' AS source_system,
      '2026-04-06 07:00' AS ingested, true AS has_file FROM events""",
    "wrapped_results": "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS \"typeContrat\" FROM orders",
    "wrapped_results_split": """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS "typeContrat",
      '{["}, ' || chr(92) || o_orderpriority AS intitule FROM orders""",
    "json_list": "SELECT n_name AS nom, CAST(n_nationkey AS VARCHAR) AS code FROM nation",
    "referentials_read": """SELECT 'code' AS key, CAST(r_regionkey AS VARCHAR) AS value FROM region
      UNION SELECT 'libelle', r_name FROM region""",
    "checked_lines": "SELECT event_id, user_id, event_type, value FROM events",
    "csv_report": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS non_null_count, CAST(count(*) - count({c}) AS BIGINT) AS null_count,
      round(count({c}) * 100.0 / count(*), 2) AS completion_rate FROM customer"""
        for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    ),
    "upsert_table": """WITH l AS (SELECT o_custkey, o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn
        FROM orders)
      SELECT c_custkey, coalesce(o_orderpriority, c_mktsegment) AS c_mktsegment, coalesce(o_orderkey, 0) AS batch FROM customer
      LEFT JOIN l ON o_custkey = c_custkey AND rn = 1""",
    "view_rows": "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
}
