"""Employers of offers and their register entry.

These follow a written specification of the tables; the matching rule is our own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobscape.functions.text import is_not_blank
from jobscape.operators.matching import employer_candidates, match_employers, normalize_name, with_candidate_id

PLACE = ["postal_code", "commune_code", "naf_code"]


def int_employer_candidates(staged: DataFrame, place: list[str] = PLACE) -> DataFrame:
    """Distinct employers by normalized name, postal code, commune and activity."""
    return employer_candidates(staged, "employer_name", place)


def register_entries(register: DataFrame) -> DataFrame:
    """Register records as match targets."""
    unit, place = "uniteLegale", "adresseEtablissement"
    return register.select(
        "siret",
        "siren",
        F.coalesce(f"{unit}.denominationUniteLegale", f"{unit}.nomUniteLegale").alias("legal_name"),
        F.col(f"{unit}.categorieJuridiqueUniteLegale").alias("legal_category"),
        F.get("periodesEtablissement", F.lit(0))["enseigne1Etablissement"].alias("trade_name"),
        F.col(f"{unit}.activitePrincipaleUniteLegale").alias("register_naf_code"),
        F.col(f"{place}.codePostalEtablissement").alias("postal_code"),
        F.col("trancheEffectifsEtablissement").alias("employee_size_range"),
    )


def raw_matches(candidates: DataFrame, entries: DataFrame, run_id: str) -> DataFrame:
    """The match kept for every candidate, with the run that made it."""
    return match_employers(candidates, entries).withColumn("run_id", F.lit(run_id))


def search_results(candidates: DataFrame, entries: DataFrame, run_id: str) -> DataFrame:
    """Audit of the register searches, one row per term and place: what was asked and how many entries were found by name.

    ``request_payload`` is the question as JSON. ``search_id`` hashes it with the run, so that a missing place and
    an empty one differ; candidates that differ in their activity only share a search.
    """
    keys = ["normalized_employer_name", "postal_code"]
    found = (
        entries.withColumn("normalized_employer_name", normalize_name("legal_name"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_found"), F.min("siret").alias("first_siret"))
    )
    asked = candidates.select(*keys, "commune_code").distinct()
    searched = asked.join(found, keys, "left").select(
        F.col("normalized_employer_name").alias("search_term"),
        "postal_code",
        "commune_code",
        F.coalesce("n_found", F.lit(0)).alias("n_found"),
        F.lit(run_id).alias("run_id"),
        F.to_json(
            F.struct(F.col("normalized_employer_name").alias("term"), "postal_code", "commune_code"), {"ignoreNullFields": "false"}
        ).alias("request_payload"),
        F.to_json(
            F.struct(F.coalesce("n_found", F.lit(0)).alias("total"), "first_siret"), {"ignoreNullFields": "false"}
        ).alias("response_payload"),
    )
    return searched.withColumn("search_id", F.sha2(F.concat_ws("|", "run_id", "request_payload"), 256))


def stg_register_matches(matches: DataFrame) -> DataFrame:
    """One row per candidate: the match with the details of its register entry, which the match carries."""
    return matches.select(
        "employer_candidate_id", "siren", "siret", "legal_name", "legal_category", "trade_name",
        F.col("register_naf_code").alias("naf_code"),
        "postal_code", "commune_code", "employee_size_range", "match_method", "match_confidence", "match_status",
    )


def with_employers(staged: DataFrame, matches: DataFrame, place: list[str] = PLACE) -> DataFrame:
    """Every offer with its candidate and, where there is one, its register entry.

    ``matches`` is the kept match table, so it has a known size. It holds the normalized name and the place columns,
    or else the id of the candidates, a long hash of them that is dearer to make, to move and to sort."""
    keys = ["normalized_employer_name", *place]
    named = staged.withColumn(keys[0], normalize_name("employer_name"))
    keyed = with_candidate_id(named, keys).withColumn(
        "employer_candidate_id", F.when(F.col(keys[0]).isNotNull(), F.col("employer_candidate_id"))
    )
    by = keys if set(keys) <= set(matches.columns) else ["employer_candidate_id"]
    # Missing parts of a place are equal inside a struct, as they are in the id.
    whole = F.struct(*(F.col(c).cast("string").alias(f"_{i}") for i, c in enumerate(by)))
    found = matches.filter(F.col(by[0]).isNotNull()).select(
        F.xxhash64(whole).alias("_hash"), whole.alias("_whole"), "siren", "siret", "legal_name", "match_confidence",
        F.col("match_status").alias("_status"),
    )
    # Most offers name no employer: they stay out of the join. Names without a letter or figure are spread over it,
    # so that they do not all meet in one task. Rows are sorted by a number first.
    has_name = F.coalesce(is_not_blank("employer_name"), F.lit(False))
    number = F.when(F.col(by[0]).isNotNull(), F.xxhash64(whole)).otherwise(F.xxhash64("offer_id"))
    linked = (
        keyed.filter(has_name)
        .withColumn("_key", number)
        .join(found, (F.col("_key") == F.col("_hash")) & (whole == F.col("_whole")), "left")
        .withColumn("match_status", F.coalesce("_status", F.lit("unmatched")))
        .drop("_key", "_hash", "_whole", "_status")
    )
    entry = {c: F.lit(None).cast(matches.schema[c].dataType) for c in ("siren", "siret", "legal_name", "match_confidence")}
    return linked.unionByName(keyed.filter(~has_name).withColumns({**entry, "match_status": F.lit("unmatched")}))


def int_offer_employers(staged: DataFrame, matches: DataFrame, place: list[str] = PLACE) -> DataFrame:
    """The employer link alone: one row per offer."""
    return with_employers(staged, matches, place).select(
        "offer_id", "employer_candidate_id", "siren", "siret", "legal_name", "match_confidence", "match_status"
    )
