"""Named files, layered tables and audit tables: written to the shared folder or the warehouse and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from jobscape.session import scratch_path
from jobscape.sinks.files import write_json_list, write_ndjson
from jobscape.sinks.tables import append_run, layer_table, materialize_table, replace_table, truncate_load
from jobscape.sources import files
from workload.tables import table, text


def _unused(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


def _renamed(spark, folder: str, target: str, prefix: str, suffix: str) -> None:
    """Moves the part files of a folder to a folder of files with telling names."""
    context = spark.sparkContext
    Path = context._jvm.org.apache.hadoop.fs.Path
    store = Path(folder).getFileSystem(context._jsc.hadoopConfiguration())
    store.mkdirs(Path(target))
    parts = [s.getPath() for s in store.listStatus(Path(folder)) if s.getPath().getName().startswith("part-")]
    for n, part in enumerate(parts):
        store.rename(part, Path(f"{target}/{prefix}{n:04d}{suffix}"))


def offers_any(spark, sf):
    """Orders in a folder of line files and wrapped documents; files of other names are passed over."""
    target = scratch_path(spark, "mixed")
    orders = table(spark, sf, "orders").select(text("o_orderkey").alias("id"), F.col("o_orderstatus").alias("typeContrat"))
    lines, documents = scratch_path(spark, "lines"), scratch_path(spark, "documents")
    write_ndjson(orders.filter("typeContrat = 'O'"), lines)
    _renamed(spark, lines, target, "offres_", ".ndjson")
    # Documents by the last digits of the id, each a file of its own.
    found = orders.filter("typeContrat = 'P'").groupBy(F.substring("id", -2, 2)).agg(F.collect_list(F.struct("id", "typeContrat")).alias("l"))
    wrapped = F.concat(F.lit('{"resultats": '), F.to_json("l"), F.lit("}"))
    found.select(wrapped.alias("value")).write.option("maxRecordsPerFile", 1).text(documents)
    _renamed(spark, documents, target, "offres_w", ".json")
    others = scratch_path(spark, "others")
    write_ndjson(orders.filter("typeContrat = 'F'"), others)
    _renamed(spark, others, target, "other_", ".ndjson")
    return files.parse_records(files.read_offers_any(spark, target), "id string, typeContrat string")


def latest_file_rows(spark, sf):
    """Of the two tables whose names end alike, the one whose file name comes last."""
    return spark.read.parquet(files.latest_file(spark, sf, "[nr]*ion.parquet")).select("r_regionkey", "r_name")


def register_read(spark, sf):
    return files.read_register(spark, f"{sf}/supplier.parquet", ["s_suppkey", "s_name"])


def pages_read(spark, sf):
    """A page per nation, each a file of its own."""
    path = scratch_path(spark, "pages")
    page = F.concat(F.lit("<h1>"), "n_name", F.lit("</h1>"))
    table(spark, sf, "nation").select(page.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    # File names change from run to run.
    return files.read_pages(spark, path, "*.txt").select(
        F.trim(F.col("html"), F.lit("\n")).alias("html"), (F.col("page_id") != "").alias("has_id"), F.col("url").contains("pages-").alias("has_url")
    )


def raw_referential_rows(spark, sf):
    path = scratch_path(spark, "lists")
    regions = table(spark, sf, "region").select(text("r_regionkey").alias("code"), F.col("r_name").alias("libelle"))
    write_json_list(regions, path)
    rows = files.raw_referentials(spark, path, "run-1", "*")
    return rows.select("code", "label", "run_id", F.get_json_object("raw_json", "$.libelle").alias("payload_label"))


def truncated_table(spark, sf):
    """A table of regions, truncated and loaded with nations; columns are matched by name."""
    name = layer_table(" default ", _unused("loaded"))
    regions = table(spark, sf, "region").select(F.col("r_regionkey").cast("bigint").alias("code"), F.col("r_name").alias("nom"))
    materialize_table(regions, name)
    truncate_load(table(spark, sf, "nation").select(F.col("n_name").alias("nom"), F.col("n_nationkey").cast("bigint").alias("code")), name)
    return spark.table(name)


def materialized_table(spark, sf):
    """Customers by segment, rebuilt twice: the second build replaces the first."""
    name = layer_table(None, _unused("built"), default="default")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    materialize_table(customers.filter("c_custkey < 10"), name, ["c_mktsegment"])
    materialize_table(customers, name, ["c_mktsegment"])
    return spark.table(name).select("c_custkey", "c_name", "c_mktsegment")


def replaced_table(spark, sf):
    name = _unused("replaced")
    replace_table(table(spark, sf, "nation").select("n_nationkey", "n_name", F.nullif("n_regionkey", F.lit(0)).alias("region")), name)
    return spark.table(name)


def audit_runs(spark, sf):
    """Regions and then nations appended by two runs."""
    name = _unused("audit")
    append_run(table(spark, sf, "region").select(F.col("r_name").alias("nom")), name, "run-1")
    append_run(table(spark, sf, "nation").select(F.col("n_name").alias("nom")), name, "run-2")
    return spark.table(name)


QUERIES = {
    "offers_any": offers_any,
    "latest_file_rows": latest_file_rows,
    "register_read": register_read,
    "pages_read": pages_read,
    "raw_referential_rows": raw_referential_rows,
    "truncated_table": truncated_table,
    "materialized_table": materialized_table,
    "replaced_table": replaced_table,
    "audit_runs": audit_runs,
}

ORACLE = {
    "offers_any": "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS \"typeContrat\" FROM orders WHERE o_orderstatus IN ('O', 'P')",
    "latest_file_rows": "SELECT r_regionkey, r_name FROM region",
    "register_read": "SELECT s_suppkey, s_name FROM supplier",
    "pages_read": "SELECT '<h1>' || n_name || '</h1>' AS html, true AS has_id, true AS has_url FROM nation",
    "raw_referential_rows": """SELECT CAST(r_regionkey AS VARCHAR) AS code, r_name AS label, 'run-1' AS run_id, r_name AS payload_label
      FROM region""",
    "truncated_table": "SELECT CAST(n_nationkey AS BIGINT) AS code, n_name AS nom FROM nation",
    "materialized_table": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "replaced_table": """SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name,
      CASE WHEN n_regionkey = 0 THEN '' ELSE CAST(n_regionkey AS VARCHAR) END AS region FROM nation""",
    "audit_runs": "SELECT r_name AS nom, 'run-1' AS run_id FROM region UNION ALL SELECT n_name, 'run-2' FROM nation",
}
