"""The registered queries of the pipeline's operators, each over its whole table, and their check SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from jobscape.llm import decontamination, filter_audit, language_id, licenses, main_text, near_duplicates, nearest, packing, repeats, sentence_pieces, token_alignment, token_shards, warc
from jobscape.llm.common import table
from jobscape.session import scratch_path

BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: under their source, language and order of length; those of up to three lines are licence files."""
    docs = table(spark, sf_dir, "documents")
    parts = [F.lit(""), F.col("source"), F.col("lang"), F.length(F.length("text").cast("string")).cast("string")]
    files = docs.select(
        F.col("doc_id").alias("file"),
        F.concat(F.concat_ws("/", *(F.coalesce(p, F.lit("none")) for p in parts)), F.lit("/"), F.col("doc_id").cast("string")).alias("path"),
        "text",
        F.coalesce(F.size(F.split("text", "\n")) <= 3, F.lit(False)).alias("is_license_file"),
    )
    return licenses.scan(files).withColumnRenamed("file", "doc_id")


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "token-shards")
    token_shards.write_shards(docs, folder, BYTE_MODEL, token_shards.train_dictionary(docs, BYTE_MODEL))
    return token_shards.read_shards(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = nearest.usable(table(spark, sf_dir, "embeddings"))
    return nearest.nearest(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    warc.register(spark)
    folder = scratch_path(spark, "warc")
    warc.page_records(table(spark, sf_dir, "pages"), "2026-01-01T00:00:00Z").write.format("warc").mode("append").save(folder)
    # Payloads of responses are read; of revisits the headers alone.
    responses = warc.read_archive(spark, folder).filter(F.col("record_type") == "response").select(
        "record_id", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "record_type", "refers_to",
    )
    revisits = warc.read_archive(spark, folder).filter(F.col("record_type") == "revisit").select(
        "record_id", "payload_bytes", F.expr("substr(payload_digest, 8)").alias("payload_digest"), "record_type", "refers_to"
    )
    return responses.unionByName(revisits).select(
        warc.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_of("refers_to").alias("refers_to"),
    )


def op10_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.encode_and_decode(table(spark, sf_dir, "documents"), PIECE_MODEL).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), WORD_MODEL, keep_ids=False)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_alignment.align(table(spark, sf_dir, "documents"), BYTE_MODEL, PIECE_MODEL, keep_groups=False)
    return found.withColumnRenamed("groups", "groups_sha256")


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_licenses, op3_main_text, op4_near_duplicates, op5_token_shards, op6_repeats, op7_nearest, op8_language_id,
        op9_warc, op10_sentence_pieces, op11_filter_audit, op12_packing, op13_token_alignment,
    )
}
_TEMPLATES = ", ".join(f"('{name}', '{text}')" for name, text in licenses.TEMPLATES.items())
_COMMON = ", ".join(f"'{w}'" for w in licenses.COMMON)
ORACLE: dict[str, str] = {
    "op2_licenses": f"""
        WITH files AS (
            SELECT doc_id AS file, text, len(string_split(text, chr(10))) <= 3 AS is_license_file,
                   '/' || coalesce(source, 'none') || '/' || coalesce(lang, 'none') || '/'
                   || coalesce(CAST(length(CAST(length(text) AS VARCHAR)) AS VARCHAR), 'none') || '/' || doc_id AS path
            FROM documents),
        templates(license, text) AS (VALUES {_TEMPLATES}),
        t_terms AS (SELECT license, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM templates),
        telling AS (SELECT list(DISTINCT term) AS words FROM t_terms WHERE term NOT IN ({_COMMON})),
        split AS (SELECT file, regexp_split_to_array(text, '\\r\\n|\\n|\\r') AS parts FROM files),
        lines AS (SELECT file, unnest(range(len(parts))) AS line, unnest(parts) AS content FROM split),
        words AS (SELECT file, line, regexp_extract_all(lower(content), '[a-z0-9]+') AS terms FROM lines),
        found AS (SELECT file, line, terms FROM words, telling WHERE len(list_intersect(terms, words)) >= 2),
        l_terms AS (SELECT file, line, unnest(terms) AS term FROM found),
        needed AS (SELECT term FROM l_terms UNION SELECT term FROM t_terms),
        d_terms AS (SELECT file, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) AS term FROM files),
        df AS (SELECT term, count(*) AS df FROM d_terms WHERE term IN (FROM needed) GROUP BY term),
        idf AS (SELECT term, ln((1 + (SELECT count(*) FROM files)) / (1 + coalesce(df, 0))) + 1 AS idf FROM needed LEFT JOIN df USING (term)),
        l_raw AS (SELECT file, line, term, (1 + ln(count(*))) * any_value(idf) AS raw FROM l_terms JOIN idf USING (term) GROUP BY ALL),
        l_vec AS (SELECT file, line, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY file, line)) AS weight FROM l_raw),
        t_raw AS (SELECT license, term, (1 + ln(count(*))) * any_value(idf) AS raw FROM t_terms JOIN idf USING (term) GROUP BY ALL),
        t_vec AS (SELECT license, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY license)) AS goal FROM t_raw),
        cosine AS (SELECT file, line, license, round(sum(weight * goal), 4) AS score FROM l_vec JOIN t_vec USING (term) GROUP BY ALL),
        own AS (SELECT file, license, score FROM cosine WHERE score >= 0.7
                QUALIFY row_number() OVER (PARTITION BY file ORDER BY score DESC, license) = 1),
        placed AS (SELECT file, path, is_license_file, regexp_replace(path, '/[^/]*$', '') AS folder FROM files),
        of_folder AS (SELECT folder AS above, license AS inherited FROM placed JOIN own USING (file) WHERE is_license_file
                      QUALIFY row_number() OVER (PARTITION BY folder ORDER BY score DESC, license) = 1),
        near AS (SELECT DISTINCT folder, above, inherited FROM placed JOIN of_folder
                 ON folder = above OR starts_with(folder, above || '/')),
        nearest AS (SELECT folder, above, inherited FROM near
                    QUALIFY row_number() OVER (PARTITION BY folder ORDER BY length(above) DESC) = 1)
        SELECT file AS doc_id, path, coalesce(license, inherited) AS license, score,
               CASE WHEN license IS NOT NULL THEN 'own' WHEN inherited IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
               CASE WHEN license IS NULL THEN above END AS inherited_from
        FROM placed LEFT JOIN own USING (file) LEFT JOIN nearest USING (folder)""",
    "op11_filter_audit": """
        WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
        w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM d),
        e AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
        b AS (SELECT doc_id, part,
                     CAST(len(words) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INT)
                     + 4 * CAST(100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) AS INT)
                     + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(doc_id > first, false) AS INT) AS bits
              FROM w JOIN e USING (text)),
        l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
              FROM labels GROUP BY doc_id),
        c AS (SELECT part, bits, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
              FROM b LEFT JOIN l USING (doc_id) GROUP BY ALL),
        f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
        o AS (SELECT f1.letter || f2.letter || f3.letter || f4.letter || f5.letter AS filter_order,
                     [f1.bit, f2.bit, f3.bit, f4.bit, f5.bit] AS own
              FROM f f1, f f2, f f3, f f4, f f5 WHERE f1.bit + f2.bit + f3.bit + f4.bit + f5.bit = 31
              AND len(list_distinct([f1.bit, f2.bit, f3.bit, f4.bit, f5.bit])) = 5),
        s AS (SELECT filter_order, CAST(step AS INT) AS step, own[step] AS own, CAST(coalesce(list_sum(own[1:step - 1]), 0) AS INT) AS before
              FROM o, range(1, 6) r(step)),
        t AS (SELECT part, filter_order, step, own,
                     coalesce(sum(n) FILTER (bits & (own | before) = 0), 0) AS kept,
                     coalesce(sum(n) FILTER (bits & own <> 0 AND bits & before = 0), 0) AS removed,
                     coalesce(sum(n) FILTER (bits & own <> 0 AND bits & before <> 0), 0) AS redundant,
                     coalesce(sum(n) FILTER (bits = own), 0) AS unique_fails,
                     coalesce(sum(n) FILTER (bits & own <> 0 AND bits & before = 0 AND good), 0) AS good_lost,
                     coalesce(sum(n) FILTER (bits & own <> 0 AND bits & before = 0 AND toxic), 0) AS toxic_lost
              FROM c, s GROUP BY ALL)
        SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
               CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
        FROM t""",
    "op9_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
        FROM f""",
}
