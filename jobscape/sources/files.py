"""Landing files as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window, functions as F, types as T

from jobscape.schemas import struct_of
from jobscape.sources.json_lists import BLOCK_BYTES, parsed_items, read_json_items

BAD = "_corrupt_record"


def read_ndjson(
    spark: SparkSession, path: str, layout: str | T.StructType, unknown: str = "ignore"
) -> DataFrame:
    """One JSON object per line, typed by ``layout``. A line that does not fit fails the read.

    Keys outside the layout are dropped, or fail the read with ``unknown="reject"``; then
    lines are checked whole, at every depth. A path pattern reads its own level only, so a
    ``done/`` folder below it stays out.
    """
    schema = struct_of(layout)
    if unknown == "ignore":
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if unknown != "reject":
        raise ValueError(f"unknown must be ignore or reject, not {unknown}")
    lines = raw_lines(spark, path)
    extra = unknown_keys(F.parse_json("raw_json"), schema)
    checked = lines.filter(
        F.when(F.array_size(extra) == 0, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("unknown keys in "), "source_file", F.lit(": "), F.array_join(extra, ", ")))
        )
    )
    return _checked(checked, schema)


def read_ndjson_checked(spark: SparkSession, path: str, layout: str | T.StructType, before: bool = False) -> DataFrame:
    """Like ``read_ndjson``, with every line read whole and required to be one JSON object;
    the error names the file and shows the line. Slower: no key can be left unread.

    With ``before`` the lines are checked at once, before anything is read from the result, and the error also tells
    the number of the first bad line.
    """
    if before:
        bad = bad_lines(spark, path, layout).orderBy("source_file", "line_number").limit(1).collect()
        if bad:
            raise ValueError(f"malformed line in {bad[0]['source_file']}:{bad[0]['line_number']}: {bad[0]['raw_json'][:200]}")
    return _checked(raw_lines(spark, path), struct_of(layout))


def bad_lines(spark: SparkSession, path: str, layout: str | T.StructType) -> DataFrame:
    """(source_file, line_number, raw_json) of every line that is no JSON object of the layout; blank lines count, but are not bad.

    A line's number is that of the lines in the blocks of its file before, counted apart, and its place in its own
    block; so files are numbered in many tasks, and no line is moved for it.
    """
    numbered = _all_lines(spark.read, path)
    block = ["source_file", "block_start"]
    blocks = numbered.groupBy(*block).agg(F.count(F.lit(1)).alias("n"), F.min("line_in_task").alias("first"))
    earlier = F.sum("n").over(Window.partitionBy("source_file").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1))
    placed = blocks.select(*block, "first", F.coalesce(earlier, F.lit(0)).alias("earlier"))
    parsed = numbered.filter("raw_json <> ''").withColumn("r", _permissive(F.col("raw_json"), struct_of(layout)))
    number = F.col("earlier") + F.col("line_in_task") - F.col("first") + 1
    return parsed.filter(~_is_good("r")).join(placed, block).select("source_file", number.alias("line_number"), "raw_json")


def _checked(lines: DataFrame, schema: T.StructType) -> DataFrame:
    parsed = lines.withColumn("r", _permissive(F.col("raw_json"), schema))
    complaint = F.concat(F.lit("malformed line in "), "source_file", F.lit(": "), F.left("raw_json", F.lit(200)))
    good = parsed.filter(F.when(_is_good("r"), F.lit(True)).otherwise(F.raise_error(complaint)))
    return good.select(*[F.col(f"r.`{f.name}`") for f in schema.fields])


def read_ndjson_split(
    spark: SparkSession, path: str, layout: str | T.StructType
) -> tuple[DataFrame, DataFrame]:
    """The readable rows, and the rejected lines as (source_file, raw_json)."""
    schema = struct_of(layout)
    parsed = raw_lines(spark, path).withColumn("r", _permissive(F.col("raw_json"), schema))
    good = parsed.filter(_is_good("r")).select(*[F.col(f"r.`{f.name}`") for f in schema.fields])
    return good, parsed.filter(~_is_good("r")).select("source_file", "raw_json")


def _permissive(line: Column, schema: T.StructType) -> Column:
    wide = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    return F.from_json(line, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})


def _is_good(record: str) -> Column:
    # A line that is JSON but no object parses to nulls without being marked.
    return F.col(f"{record}.{BAD}").isNull() & F.startswith(F.ltrim("raw_json"), F.lit("{"))


def raw_lines(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(source_file, block_start, line_in_task, raw_json) of every non-blank line.

    The first three columns order lines as they stand in the files, also for files that
    are read in several blocks.
    """
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    return _all_lines(reader, path).filter("raw_json <> ''")


def _all_lines(reader: DataFrameReader, path: str) -> DataFrame:
    return reader.text(path).select(
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_in_task"),
        F.trim("value").alias("raw_json"),
    )


READING_ORDER = ("source_file", "block_start", "line_in_task")


def raw_with_lineage(lines: DataFrame, record: str = "raw_json", key: str = "id") -> DataFrame:
    """(offer_id, source_file, raw_json): the payload untouched, with its key and file."""
    return lines.select(
        F.get_json_object(record, f"$.{key}").alias("offer_id"), "source_file", F.col(record).alias("raw_json")
    )


def parse_records(lines: DataFrame, layout: str | T.StructType, record: str = "raw_json") -> DataFrame:
    """JSON text as typed columns; text that does not fit fails the query."""
    schema = struct_of(layout)
    parsed = lines.select(F.from_json(record, schema, {"mode": "FAILFAST"}).alias("r"))
    return parsed.select(*[F.col(f"r.`{f.name}`") for f in schema.fields])


def unknown_keys(value: Column, layout: T.DataType, at: str = "") -> Column:
    """Paths of a JSON value (a variant) that a layout does not know, at every depth."""
    empty = F.array().cast("array<string>")
    if isinstance(layout, T.ArrayType):
        if not isinstance(layout.elementType, (T.StructType, T.ArrayType)):
            return empty
        items = F.coalesce(value.try_cast("array<variant>"), F.array().cast("array<variant>"))
        return F.flatten(F.transform(items, lambda v: unknown_keys(v, layout.elementType, f"{at}[]")))
    if not isinstance(layout, T.StructType):
        return empty
    keys = F.map_keys(value.try_cast("map<string,variant>"))
    names = F.array(*[F.lit(f.name) for f in layout.fields])
    here = F.transform(F.array_except(keys, names), lambda k: F.concat(F.lit(f"{at}." if at else ""), k))
    parts = [F.coalesce(here, empty)]
    for f in layout.fields:
        if isinstance(f.dataType, (T.StructType, T.ArrayType)):
            inner = F.try_variant_get(value, f"$['{f.name}']", "variant")
            parts.append(F.coalesce(unknown_keys(inner, f.dataType, f"{at}.{f.name}" if at else f.name), empty))
    return F.concat(*parts)


def json_documents(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(source_file, value): each file whole. Files hold one extraction, so they are bounded."""
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    return reader.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("source_file"), "value")


def read_json_list(
    spark: SparkSession, path: str, layout: str | T.StructType, pattern: str | None = None, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Records of files that hold a JSON list, each file read by many tasks; any other shape fails the query."""
    return parsed_items(read_json_items(spark, path, pattern, block_bytes=block_bytes), struct_of(layout))


def read_wrapped(
    spark: SparkSession, path: str, pattern: str | None = None, key: str = "resultats", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(source_file, block_start, line_in_task, raw_json): the objects of files that are a list, or hold one under ``key``."""
    return read_json_items(spark, path, pattern, key, block_bytes)


def unwrap_results(documents: DataFrame, key: str = "resultats") -> DataFrame:
    """(source_file, pos, raw_json): the objects of a list, or of the list under ``key``.

    Items that are no objects are dropped; a document of another shape fails the query.
    """
    body = F.regexp_replace("value", r"^\s+", "")
    in_list = F.from_json(body, "array<string>")
    in_object = F.from_json(body, f"struct<`{key}` string>")[key]
    items = (
        F.when(F.startswith(body, F.lit("[")), in_list)
        .when(F.startswith(body, F.lit("{")) & F.startswith(in_object, F.lit("[")), F.from_json(in_object, "array<string>"))
    )
    shape = F.lit(f": expected a list or an object with a list under {key}")
    return (
        documents.select("source_file", F.coalesce(items, F.raise_error(F.concat("source_file", shape)).cast("array<string>")).alias("items"))
        .select("source_file", F.posexplode("items").alias("pos", "raw_json"))
        .filter(F.startswith("raw_json", F.lit("{")))
    )


def list_items(documents: DataFrame) -> DataFrame:
    """(source_file, pos, raw_json): the objects of documents that are lists; others have none."""
    body = F.regexp_replace("value", r"^\s+", "")
    return (
        documents.filter(F.startswith(body, F.lit("[")))
        .select("source_file", F.posexplode(F.from_json(body, "array<string>")).alias("pos", "raw_json"))
        .filter(F.startswith("raw_json", F.lit("{")))
    )


def read_offers_any(spark: SparkSession, folder: str, pattern: str = "offres_*") -> DataFrame:
    """Raw offers of a folder that mixes line files and wrapped documents, by suffix.

    The order columns are those of ``raw_lines``.
    """
    lines = raw_lines(spark, folder, f"{pattern}.ndjson")
    return lines.unionByName(read_wrapped(spark, folder, f"{pattern}.json"))


def latest_file(spark: SparkSession, folder: str, pattern: str) -> str:
    """Path of the file whose name comes last, wherever it lies. Only names are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    last = files.agg(F.max_by("path", F.struct(name, F.col("path"))).alias("path")).first()["path"]
    if last is None:
        raise FileNotFoundError(f"no file like {pattern} in {folder}")
    return last


def read_referentials(spark: SparkSession, folder: str, pattern: str = "ref_*.json") -> DataFrame:
    """(referential, key, value): distinct scalar values of every list file, as text.

    Nulls, nested values and items that are no objects are skipped.
    """
    entry = F.explode(F.parse_json("raw_json").try_cast("map<string,variant>"))
    scalar = ~F.schema_of_variant("v").rlike("^(OBJECT|ARRAY|VOID)")
    return (
        list_items(json_documents(spark, folder, pattern))
        .select(F.regexp_replace("source_file", r"\.json$", "").alias("referential"), entry.alias("key", "v"))
        .filter(F.col("v").isNotNull() & scalar)
        .select("referential", "key", F.col("v").cast("string").alias("value"))
        .distinct()
    )


def raw_referentials(spark: SparkSession, folder: str, run_id: str, pattern: str = "ref_*.json") -> DataFrame:
    """(referential, code, label, raw_json, run_id): list entries with their payload."""
    items = list_items(json_documents(spark, folder, pattern))
    return items.select(
        F.regexp_replace("source_file", r"\.json$", "").alias("referential"),
        F.get_json_object("raw_json", "$.code").alias("code"),
        F.get_json_object("raw_json", "$.libelle").alias("label"),
        "raw_json",
        F.lit(run_id).alias("run_id"),
    )


def read_register(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The company register stock; name the columns to read only those."""
    stock = spark.read.parquet(path)
    return stock.select(*columns) if columns else stock


def read_pages(spark: SparkSession, folder: str, pattern: str = "*.html") -> DataFrame:
    """(page_id, url, html): every HTML file of a folder as one row."""
    return (
        spark.read.option("pathGlobFilter", pattern)
        .text(folder, wholetext=True)
        .select(
            F.col("_metadata.file_name").alias("page_id"),
            F.col("_metadata.file_path").alias("url"),
            F.col("value").alias("html"),
        )
    )
