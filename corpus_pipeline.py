"""The corpus pipeline: documents in; documents of a known language, without near copies, repeated passages and
benchmark passages, as token ids out.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as
the ``docs`` of the next. All but the last return the columns of documents. Rows without doc_id pass the stages that
compare documents. Columns beside those of documents are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobscape.llm import decontamination, language_id, near_duplicates, repeats, sentence_pieces
from jobscape.sinks.tables import settle

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _with_text_hash(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("text").alias("_text"))


def _without(docs: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """Rows of ``docs`` not among ``found`` (doc_id, ``_text``); the text tells apart rows without id or of one id."""
    # Written first: Spark then knows how few they are, and need not move the texts.
    rejected = settle(found.select(F.col("doc_id").alias("_id"), "_text").distinct(), name)
    same = docs["doc_id"].eqNullSafe(rejected["_id"]) & (F.xxhash64(docs["text"]) == rejected["_text"])
    return docs.join(rejected, same, "left_anti")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without text or letters go."""
    found = language_id.identify(_with_text_hash(docs), language_id.fit(docs), carried=("_text",))
    return _without(docs, found.filter(F.col("lang_pred") == language_id.UNKNOWN), "rejected")


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near copies: five-word shingles, similarity 0.8."""
    found = near_duplicates.near_duplicates(docs, words=5, percent=80)
    ids = found.filter("kept").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_id"]), "left_semi")


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document, or the same one before, has; emptied documents go."""
    found = repeats.without_repeats(docs)
    length: Column = F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return found.withColumn("n_chars", length) if length is not None else found


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.contaminated_spans(_with_text_hash(docs), benchmark, carried=("_text",))
    return _without(docs, found, "contaminated")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the piece numbers of each text, their count, and the text they decode to."""
    found = sentence_pieces.encode_and_decode(docs, PIECE_MODEL)
    return found.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.col("decoded").alias("text"))


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", one_of_near_copies),
    ("repeats", without_repeats),
    ("decontamination", decontaminated),
    ("sentence_pieces", token_ids),
]

# The stages are not expressible in SQL; the tests compare each with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
