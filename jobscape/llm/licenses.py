"""License scan: sparse TF-IDF cosine to templates, then inheritance from the nearest directory above.

Lines of the whole text that carry at least ``least_terms`` different template words, common words not counted, are
candidates (headers and the body of licence files alike). Line and template are vectors of ``(1 + ln tf) * idf``; the inverse document frequency
of a word counts the documents of the whole table that have it, ``ln((1 + N) / (1 + df)) + 1``. A line names the
template with the greatest cosine of at least ``threshold``; a file names the licence of its best line.

A directory's licence is that of its licence files (``is_license_file``); of several the best-scoring one counts.
A file without a licence of its own takes the one of the nearest directory at or above its own that has one. Every
distinct directory is joined with its ancestors once, so a directory with a third of all files is one row there;
files join the result by directory, where adaptive execution splits a frequent one.

All of it is DataFrame functions. Words are runs of ASCII letters and digits, lower-cased.
Rules: null texts, empty texts and texts without candidate lines have no licence of their own; a null path has no
directory and inherits nothing; equal cosines go to the smaller licence name; repeated rows are answered alike.
Other columns are not looked at.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from jobscape.sinks.tables import settle

# Licence names and the sentences that grant them. Fixed values.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
    "BSD-3-Clause": "Distributed under the BSD 3-Clause License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "Proprietary": "All rights reserved. Do not redistribute without written permission.",
}
# Words that say nothing about a licence. Fixed values.
COMMON = "a all and as by do for form in is it not of or terms the this to under v without work".split()
WORD = r"[a-z0-9]+"


def words(text: Column) -> Column:
    """Lower-case words in their order."""
    return F.filter(F.split(F.lower(text), r"[^a-z0-9]+"), lambda w: w != "")


def _vector(rows: DataFrame, key: list[str], idf: DataFrame) -> DataFrame:
    """Weights of length 1: the key, ``term`` and ``weight``, from rows of the key and ``term``."""
    tf = rows.groupBy(*key, "term").agg(F.count("*").alias("tf"))
    weighted = tf.join(idf, "term").select(*key, "term", ((1 + F.log("tf")) * F.col("idf")).alias("raw"))
    norms = weighted.groupBy(*key).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
    return weighted.join(norms, key).select(*key, "term", (F.col("raw") / F.col("norm")).alias("weight"))


def own_licenses(files: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = 0.7, least_terms: int = 2) -> DataFrame:
    """``file`` and the licence and score of its best line, for files (``file``, ``text``) that have one."""
    spark = files.sparkSession
    known = sorted({w for t in templates.values() for w in _plain_words(t)})
    telling = F.array(*(F.lit(w) for w in known if w not in COMMON))
    lines = files.select("file", F.posexplode(F.split("text", r"\r\n|\n|\r")).alias("line", "content"))
    lines = lines.withColumn("terms", words(F.col("content"))).filter(F.size(F.array_intersect("terms", telling)) >= least_terms)
    terms = settle(lines.select("file", "line", F.explode("terms").alias("term")), "license-lines")
    needed = settle(terms.select("term").unionByName(spark.createDataFrame([(w,) for w in known], "term string")).distinct(), "license-terms")
    # Document frequencies of the words that occur in candidate lines, over all documents.
    texts = files.select(F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    counts = texts.join(needed, "term", "left_semi").groupBy("term").agg(F.count("*").alias("df"))
    rarity = F.log((1 + F.lit(files.count())) / (1 + F.coalesce("df", F.lit(0)))) + 1
    idf = needed.join(counts, "term", "left").select("term", rarity.alias("idf"))
    idf = settle(idf, "license-idf")
    template_rows = [(name, w) for name, t in sorted(templates.items()) for w in _plain_words(t)]
    of_template = _vector(spark.createDataFrame(template_rows, "license string, term string"), ["license"], idf)
    of_template = settle(of_template.withColumnRenamed("weight", "goal"), "license-templates")
    of_line = _vector(terms, ["file", "line"], idf)
    cosine = of_line.join(of_template, "term").groupBy("file", "line", "license").agg(F.round(F.sum(F.col("weight") * F.col("goal")), 4).alias("score"))
    return _best(cosine.filter(F.col("score") >= threshold), ["file"])


def _best(rows: DataFrame, key: list[str]) -> DataFrame:
    """The licence with the greatest score per key; of equals the smaller name."""
    top = F.min(F.struct((-F.col("score")).alias("minus"), F.col("license"))).alias("top")
    return rows.groupBy(*key).agg(top).select(*key, F.col("top.license").alias("license"), (-F.col("top.minus")).alias("score"))


def _plain_words(text: str) -> list[str]:
    return re.findall(WORD, text.lower())


def directory(path: Column) -> Column:
    """The directory of a path, without the slash at its end; '' for the root."""
    return F.regexp_replace(path, r"/[^/]*$", "")


def ancestors(folder: Column) -> Column:
    """The directory itself and all above it, the root '' last."""
    parts = F.split(folder, "/")
    return F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def scan(files: DataFrame, **options) -> DataFrame:
    """file, path, license, score and ``origin`` (own, inherited, none) of files (file, path, text, is_license_file)."""
    own = settle(own_licenses(files, **options), "own-licenses")
    placed = files.select("file", "path", "is_license_file", directory(F.col("path")).alias("folder"))
    of_folder = _best(placed.filter("is_license_file and folder is not null").join(own, "file").select("folder", "license", "score"), ["folder"])
    of_folder = settle(of_folder.withColumnRenamed("folder", "above"), "folder-licenses")
    folders = placed.filter("folder is not null").select("folder").distinct()
    above = folders.select("folder", F.explode(ancestors(F.col("folder"))).alias("above")).join(of_folder, "above")
    nearest = above.groupBy("folder").agg(F.max(F.struct(F.length("above").alias("n"), F.col("above"), F.col("license"))).alias("near"))
    nearest = settle(nearest.select("folder", F.col("near.license").alias("inherited"), F.col("near.above").alias("from")), "nearest-licenses")
    joined = placed.join(own, "file", "left").join(nearest, "folder", "left")
    return joined.select(
        "file", "path",
        F.coalesce("license", "inherited").alias("license"),
        "score",
        F.when(F.col("license").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(F.col("license").isNull(), F.col("from")).alias("inherited_from"),
    )
