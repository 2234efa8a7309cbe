"""Tables with the rows that operators must bear."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that operators use as names of their own.
CLASHING = ("doc", "n", "ids", "node", "component", "kept", "marks", "packed", "file", "row", "key", "place")


def documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rng = random.Random(4)
    long = " ".join(rng.choice("lorem ipsum dolor sit amet magna aliqua éé ß".split()) + str(rng.randint(0, 99)) for _ in range(40_000))
    rows = [
        (1, "the cat sat on the mat and looked at the dog", "en", "a", 44),
        (2, "THE CAT sat on the mat and looked at the dog", "en", "a", 44),
        (3, None, "en", "a", None),
        (4, "", "en", "a", 0),
        (5, " \n\t ", None, None, 4),
        (6, long, "la", "b", len(long)),
        (7, long + " end", "la", "b", len(long) + 4),
        (8, "x", None, "b", 1),
        (9, "12345 --- !!!", "en", "b", 13),
        (None, "a row without an id", "en", "b", 19),
        (None, None, None, None, None),
        (10, "same words here", "en", "a", 15),
        (10, "same words here", "en", "a", 15),
        (11, "der hund und die katze sind im haus", "de", "c", 35),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def with_clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("x") for c in CLASHING})
