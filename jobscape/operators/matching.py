"""Distinct employers and their match in the company register."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobscape.functions.text import _col, is_not_blank
from jobscape.operators.scale import first_per_key
from jobscape.sinks.tables import settle

# Accented capitals and their plain letters, and company forms that a
# name may carry or not.
ACCENTED = "ÀÂÄÇÉÈÊËÎÏÔÖÙÛÜŸ"
PLAIN = "AAACEEEEIIOOUUUY"
COMPANY_FORMS = ("SA", "SAS", "SASU", "SARL", "EURL", "SCI", "SNC", "SCOP")


def normalize_name(c: Column | str) -> Column:
    """Comparable company name: upper case, no accents, signs or company forms; null when empty."""
    upper = F.upper(_col(c))
    # Only names with letters beyond ASCII are longer in bytes than in characters.
    plain = F.when(F.octet_length(upper) > F.length(upper), F.translate(upper, ACCENTED, PLAIN)).otherwise(upper)
    words = F.regexp_replace(plain, "[^A-Z0-9]+", " ")
    bare = F.regexp_replace(words, rf"(^| )({'|'.join(COMPANY_FORMS)})(?= |$)", "")
    return F.nullif(F.trim(bare), F.lit(""))


def employer_candidates(df: DataFrame, name: str, place: Sequence[str]) -> DataFrame:
    """Distinct employers: normalized name and place columns, with their number of offers.

    One aggregation, combined map-side: an employer with very many offers is one row per task before the shuffle.
    """
    key = "normalized_employer_name"
    # Rows without a normalized name sum to null: a test on the sum is made after grouping.
    counted = (
        df.filter(is_not_blank(name))
        .withColumn(key, normalize_name(name))
        .groupBy(key, *place)
        .agg(F.sum(F.when(F.col(key).isNotNull(), 1)).alias("offer_count"))
        .filter("offer_count > 0")
    )
    return with_candidate_id(counted, [key, *place])


def with_candidate_id(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``employer_candidate_id``: a hash of the key columns, the same in every run."""
    # As JSON a missing value and an empty one differ, and no value runs into the next.
    parts = F.to_json(F.array(*(F.col(k).cast("string") for k in keys)))
    return df.withColumn("employer_candidate_id", F.sha2(parts, 256))


def one_edit_keys(name: Column | str) -> Column:
    """The name and every form with one character left out.

    Two names at most one edit apart always share such a form, and the names sharing one
    form differ in a single place, so their number is bounded by the alphabet.
    """
    n = _col(name)
    shorter = F.transform(
        F.sequence(F.lit(1), F.length(n)),
        lambda i: F.concat(F.substring(n, F.lit(1), i - 1), F.substring(n, i + 1, F.length(n))),
    )
    return F.array_distinct(F.array_append(shorter, n))


# The characters of normalized names. Their pairs are numbered, so the list of frequencies has a bounded size.
LETTERS = " ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
LEAST_PERCENT = 85


def most_edits(longer: Column, least_percent: int) -> Column:
    """How many edits leave two names, the longer one of this length, alike by so many percent."""
    return F.floor(longer * (100 - least_percent) / 100).cast("int")


def _letter_pairs(name: Column) -> Column:
    at = F.sequence(F.lit(1), F.length(name) - 1)
    pairs = F.transform(at, lambda i: F.substring(name, i, F.lit(2)))
    return F.when(F.length(name) > 1, pairs).otherwise(F.array().cast("array<string>"))


def _pair_number(letters: Column) -> Column:
    """The number of a pair of letters; a character outside ``LETTERS`` counts as 0."""
    place = lambda i: F.position(F.substring(letters, i, 1), F.lit(LETTERS))
    return place(1) * (len(LETTERS) + 1) + place(2)


def pair_ranks(names: DataFrame, name: str) -> list[int]:
    """By pair number, how many of the ``names`` hold it: one count per pair of letters, whatever the number of names."""
    pairs = names.select(F.explode(F.array_distinct(_letter_pairs(F.col(name)))).alias("letters"))
    counts = dict(pairs.groupBy(_pair_number(F.col("letters")).alias("pair")).count().collect())
    return [counts.get(i, 0) for i in range((len(LETTERS) + 1) ** 2)]


def rare_pairs(names: DataFrame, name: str, ranks: list[int], least_percent: int) -> DataFrame:
    """``names`` once for each of the rarest letter pairs of its name: ``_letters``, ``_nth`` occurrence and place ``_at``.

    A partner of a name of n letters has at most n / share letters and is at most k edits away. An edit touches two
    pairs, so both names have one of their 2 k + 1 rarest pairs in common, in whatever order pairs count as rare.
    """
    pairs = _letter_pairs(F.col(name))
    earlier = lambda p, i: F.size(F.filter(F.slice(pairs, F.lit(1), i), lambda q: q == p))
    numbered = F.transform(
        pairs,
        lambda p, i: F.struct(F.get(F.lit(ranks), _pair_number(p)).alias("rank"), p.alias("letters"), earlier(p, i).alias("nth"), i.alias("at")),
    )
    longest = F.floor(F.length(name) * 100 / least_percent)
    rarest = F.slice(F.array_sort(numbered), F.lit(1), 2 * most_edits(longest, least_percent) + 1)
    return names.withColumn("_pair", F.explode(rarest)).select(
        *names.columns, F.col("_pair.letters").alias("_letters"), F.col("_pair.nth").alias("_nth"), F.col("_pair.at").alias("_at")
    )


def ratio_candidates(left: DataFrame, right: DataFrame, name: str, other: str, block: str, least_percent: int = LEAST_PERCENT) -> DataFrame:
    """Pairs of ``left`` and ``right`` rows of one block whose names may be alike by ``least_percent``, more than one edit apart.

    A set-similarity join with a prefix filter: only names that share one of their rarest letter pairs, about as far
    from the start, and that are about as long, meet. A pair may come more than once.
    """
    if not 70 <= least_percent <= 100:
        raise ValueError("names alike by less than 70 percent need not share a rare pair of letters")
    # Two edits are within the bound from this length on.
    least_length = -(-200 // (100 - least_percent)) * least_percent // 100 if least_percent < 100 else 1 << 30
    long = [df.filter(F.length(c) >= least_length) for df, c in ((left, name), (right, other))]
    ranks = pair_ranks(long[0].select(name).union(long[1].select(other)), name)
    (a, b) = (rare_pairs(df, c, ranks, least_percent) for df, c in zip(long, (name, other)))
    b = b.withColumnRenamed("_at", "_other_at")
    edits = most_edits(F.greatest(F.length(name), F.length(other)), least_percent)
    near = (F.abs(F.col("_at") - F.col("_other_at")) <= edits) & (F.abs(F.length(name) - F.length(other)) <= edits)
    return a.join(b, [block, "_letters", "_nth"]).filter(near).drop("_letters", "_nth", "_at", "_other_at")


def match_employers(
    candidates: DataFrame, register: DataFrame, postal_code: str = "postal_code", least_percent: int = LEAST_PERCENT
) -> DataFrame:
    """One row per candidate with its register entry, method, confidence and status.

    ``candidates`` holds ``employer_candidate_id``, ``normalized_employer_name`` and the
    postal code; ``register`` holds ``siret``, ``siren``, ``legal_name``, the postal
    code and any details, which the match carries along. Within a postal code an equal normalized name is an ``exact``
    match (confidence 1); else the name with the fewest edits is a ``fuzzy`` one (confidence 1 - edits/longer length),
    when it is one edit away or alike by ``least_percent``; ties go to the smallest siret. All steps are equality
    joins, never all pairs: one edit by forms with one character left out, more by shared rare letter pairs.

    The register is read and its names are normalized once, for postal codes that some candidate has. Its entries meet the
    candidates in one full join, which is written: it holds the exact matches, the open candidates and all entries. Names
    are cut into forms only in postal codes that have both an open candidate and an entry.
    """
    name = "normalized_employer_name"
    key = [name, postal_code]
    details = [c for c in register.columns if c not in ("siret", "siren", "legal_name", postal_code)]
    kept = ["siret", "siren", "legal_name", *details]
    asked = [*key, *(c for c in candidates.columns if c not in key)]
    listed = (
        register.join(candidates.select(postal_code).distinct(), postal_code, "left_semi")
        .select(*kept, F.col(postal_code).alias("_place"), normalize_name("legal_name").alias("_name"))
        .filter(F.col("_name").isNotNull())
    )
    # Rows are sorted by place first: names often begin alike, and are slow to compare then.
    first = first_per_key(listed, ["_place", "_name"], [F.col("siret").asc()])
    same = (F.col(postal_code) == F.col("_place")) & (F.col(name) == F.col("_name"))
    looked = settle(candidates.select(*asked, F.lit(True).alias("_asked")).join(first, same, "full"), "register-names")

    exact = looked.filter(F.col("_asked") & F.col("_name").isNotNull())
    unmatched = looked.filter(F.col("_asked") & F.col("_name").isNull()).select(*asked)
    entries = looked.filter(F.col("_name").isNotNull()).select(*kept, F.col("_place").alias(postal_code), "_name")
    open_names = settle(
        unmatched.select(*key).distinct().join(entries.select(postal_code).distinct(), postal_code, "left_semi").select(*key), "open-names"
    )
    # An entry comes once for each candidate of its name.
    near_entries = entries.join(open_names.select(postal_code).distinct(), postal_code, "left_semi")
    left = open_names.withColumn("_form", F.explode(one_edit_keys(name)))
    right = near_entries.withColumn("_form", F.explode(one_edit_keys("_name")))
    one_edit = left.join(right, [postal_code, "_form"]).drop("_form")
    several = ratio_candidates(open_names, near_entries, name, "_name", postal_code, least_percent)
    longer = F.greatest(F.length(name), F.length("_name"))
    allowed = F.greatest(F.lit(1), most_edits(longer, least_percent))
    near = (
        one_edit.unionByName(several.select(*one_edit.columns))
        .withColumn("_edits", F.levenshtein(F.col(name), F.col("_name")))
        .filter(F.col("_edits") <= allowed)
    )
    best = first_per_key(near, key, [F.col("_edits"), F.col("siret")])
    fuzzy = best.select(
        *key, *kept, F.lit("fuzzy").alias("match_method"),
        F.round(1 - F.col("_edits") / longer, 4).alias("match_confidence"),
    )
    found = exact.select(*asked, *kept, F.lit("exact").alias("match_method"), F.lit(1.0).alias("match_confidence"))
    return found.unionByName(unmatched.join(fuzzy, key, "left").select(*found.columns)).withColumn(
        "match_status", F.when(F.col("siret").isNull(), "unmatched").otherwise("matched")
    )


def pending_candidates(candidates: DataFrame, matches: DataFrame) -> DataFrame:
    """Candidates without a kept match, to be looked up next."""
    return candidates.join(matches.select("employer_candidate_id"), "employer_candidate_id", "left_anti")
