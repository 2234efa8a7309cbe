"""Interaction audit of document filters.

Which of five filters a document fails is one number of five bits. Four bits come from its own text. The fifth, a copy
of an earlier text, is found by an existential self-join: of the hashes that occur more than once, every different
text keeps its smallest doc_id, and a left-semi join on hash, exact text and smaller doc_id marks the copies. Their
ids are united with the ids of the other failures, and the bits of a document are brought together by its id; then
only the counts of each combination of part, bits and labels are left, a table of bounded size per part, and every
order of the filters is worked out on these.

Texts of hashes that occur once are never shuffled. The copies of one text are dealt to slices of ``SLICE`` rows (its
smallest doc_id is repeated for each slice), so a text that a third of all documents share is no single task; rows
without doc_id, which cannot be compared, are counted on the map side at once.

Rules: a null text is empty, and empty texts are copies of one another; a null part is the empty string; rows without
doc_id fail no copy filter and have no labels; rows that repeat a doc_id are documents of their own, and no copies of
one another; several label rows of one doc_id count as one that holds each mark any of them holds. An empty table
has no parts. Other columns are not looked at. Everything is DataFrame functions.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

from jobscape.sinks.tables import settle

FILTERS = "ABCDE"
COPY = FILTERS.index("E")
BLANKS = r"[\x20\x09-\x0D]+"
SLICE = 1024


def own_failures(text: Column, words: Column) -> Column:
    """Bits of the filters that look at one text only."""
    letters = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    fails = (
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        100 * letters > 3 * F.length(text),
        text.rlike("[#$%&*|]"),
    )
    total = F.lit(0)
    for bit, failed in enumerate(fails):
        total = total + F.when(failed, 1 << bit).otherwise(0)
    return total


def copies(docs: DataFrame, hashed: DataFrame, slice_rows: int = SLICE) -> DataFrame:
    """The rows of ``docs`` (doc_id, part, text) whose text a smaller doc_id has too; ``hashed`` holds their hashes."""
    slices = F.ceil(F.col("n") / slice_rows).cast("long")
    repeated = settle(
        hashed.filter("doc_id is not null").groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash", slices.alias("slices")),
        "repeated-hashes",
    )
    texts = docs.filter("doc_id is not null").withColumn("hash", F.xxhash64("text")).join(repeated, "hash")
    first = texts.groupBy("hash", "text").agg(F.min("doc_id").alias("first"), F.max("slices").alias("slices"))
    first = first.select("hash", "text", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"))
    rows = texts.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.col("slices"))).alias("rows")
    same = [F.col(f"rows.{c}") == F.col(f"first.{c}") for c in ("hash", "slice", "text")]
    found = rows.join(first.alias("first"), [*same, F.col("first.first") < F.col("rows.doc_id")], "left_semi")
    return found.select("doc_id", "part", "hash")


def combinations(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """part, bits, good, toxic and n, the number of documents, of every combination that occurs."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # Without a doc_id nothing of a row is compared: such rows fall together before they are shuffled.
    identity = F.when(F.col("doc_id").isNotNull(), F.xxhash64("text"))
    split = rows.withColumn("words", F.array_remove(F.split("text", BLANKS), ""))
    bits = own_failures(F.col("text"), F.col("words"))
    failed = settle(split.select("doc_id", "part", identity.alias("hash"), bits.alias("bits")), "own-failures")
    copied = copies(rows, failed).select("doc_id", "part", "hash", F.lit(1 << COPY).alias("bits"), F.lit(0).alias("n"))
    united = failed.withColumn("n", F.lit(1)).unionByName(copied)
    known = united.groupBy("doc_id", "part", "hash").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    alone = united.filter("doc_id is null").groupBy("part", "bits").agg(F.sum("n").alias("n"))
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
        .filter("doc_id is not null and (quality = 1 or toxic = 1)")
        .groupBy("doc_id")
        .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    )
    no = F.lit(False)
    told = known.filter("doc_id is not null").join(marks, "doc_id", "left").select(
        "part", "bits", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"), "n"
    )
    told = told.unionByName(alone.select("part", "bits", no.alias("good"), no.alias("toxic"), "n"))
    return told.groupBy("part", "bits", "good", "toxic").agg(F.sum("n").alias("n"))


def _orders() -> Column:
    """Every step of every order of the filters: its own bit, and the bits of the filters before it."""
    steps = []
    for order in permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[i] for i in order), 0
        for step, i in enumerate(order, 1):
            steps.append(f"named_struct('filter_order', '{name}', 'step', {step}, 'own', {1 << i}, 'before', {before})")
            before |= 1 << i
    return F.expr(f"array({', '.join(steps)})")


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """The effect of each step of every order of the filters, for each part."""
    held = settle(combinations(docs, labels, part), "combinations")
    # The whole grid, so that steps without effect have a row of zeros.
    steps = held.select("*", F.explode(_orders()).alias("s")).select("part", "bits", "good", "toxic", "n", "s.*")
    own, early = F.col("bits").bitwiseAND(F.col("own")) != 0, F.col("bits").bitwiseAND(F.col("before")) != 0
    removed = own & ~early
    total = lambda when: F.sum(F.when(when, F.col("n")).otherwise(F.lit(0).cast("long")))
    counted = steps.groupBy("part", "filter_order", "step", "own").agg(
        total(~own & ~early).alias("kept"), total(removed).alias("removed"), total(own & early).alias("redundant"),
        total(F.col("bits") == F.col("own")).alias("unique_fails"), total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("toxic")).alias("toxic_lost"),
    )
    shares = counted.groupBy("part", "own").agg(F.sum("removed").alias("shapley"))
    return counted.join(shares, ["part", "own"]).drop("own")
