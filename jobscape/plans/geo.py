"""The place tables: one row per commune and postal code, and what derives from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobscape.functions.text import clean_trim, to_whole_number
from jobscape.operators.geo import distinct_rows, explode_codes, first_code, lookup_left, name_index

COMMUNE_COLUMNS = ["code", "nom", "codesPostaux", "codeDepartement", "codeRegion", "codeEpci", "population"]
NAME_VALUES = [
    "commune_code", "commune_nom", "code_postal", "departement_code", "departement_nom", "region_nom", "epci_nom",
]


def _with_names(
    communes: DataFrame, departments: DataFrame, regions: DataFrame, epcis: DataFrame, distinct: bool = True
) -> DataFrame:
    def dim(df: DataFrame, prefix: str) -> DataFrame:
        named = df.select(F.col("code").alias(f"_{prefix}"), F.col("nom").alias(f"_{prefix}_nom"))
        return named.distinct() if distinct else named

    return lookup_left(
        communes,
        [
            (dim(departments, "departement"), "codeDepartement", "_departement"),
            (dim(regions, "region"), "codeRegion", "_region"),
            (dim(epcis, "epci"), "codeEpci", "_epci"),
        ],
    )


def commune_names(
    communes: DataFrame, departments: DataFrame, regions: DataFrame, epcis: DataFrame
) -> DataFrame:
    """(code, departement_nom, region_nom, epci_nom) of every commune: the raw lists joined
    among themselves, so that offers are joined to one list instead of four."""
    named = _with_names(communes, departments, regions, epcis, distinct=False)
    return named.select(
        F.col("code"),
        clean_trim("_departement_nom").alias("departement_nom"),
        clean_trim("_region_nom").alias("region_nom"),
        clean_trim("_epci_nom").alias("epci_nom"),
    )


def communes_by_postal_code(
    communes: DataFrame, departments: DataFrame, regions: DataFrame, epcis: DataFrame
) -> DataFrame:
    """One row per (commune, postal code) with the names of its department, region and
    inter-communal body. Communes without postal codes drop out; unknown codes leave nulls."""
    rows = explode_codes(distinct_rows(communes, COMMUNE_COLUMNS), "codesPostaux", "cp")
    named = _with_names(rows, departments, regions, epcis)
    return named.select(
        clean_trim("code").alias("commune_code"),
        clean_trim("nom").alias("commune_nom"),
        clean_trim("cp").alias("code_postal"),
        clean_trim("_departement").alias("departement_code"),
        clean_trim("_departement_nom").alias("departement_nom"),
        clean_trim("_region_nom").alias("region_nom"),
        clean_trim("_epci_nom").alias("epci_nom"),
        to_whole_number("population").alias("population"),
    )


def communes_first_code(
    communes: DataFrame,
    departments: DataFrame,
    regions: DataFrame,
    epcis: DataFrame,
    codes_as_json: bool = False,
) -> DataFrame:
    """The one-row-per-commune form: first postal code or null, every commune kept."""
    named = _with_names(communes, departments, regions, epcis, distinct=False)
    return named.select(
        clean_trim("nom").alias("commune_nom"),
        clean_trim(first_code("codesPostaux", codes_as_json)).alias("code_postal"),
        clean_trim("_departement").alias("departement_code"),
        clean_trim("_departement_nom").alias("departement_nom"),
        clean_trim("_region_nom").alias("region_nom"),
        clean_trim("_epci_nom").alias("epci_nom"),
        to_whole_number("population").alias("population"),
    )


def communes_by_name(places: DataFrame) -> DataFrame:
    """One row per upper-cased commune and department name."""
    return name_index(
        places,
        {"commune_nom_upper": "commune_nom", "departement_nom_upper": "departement_nom"},
        NAME_VALUES,
    )


PLACE_COLUMNS = [
    "commune_code", "commune_name", "departement_code", "departement_name",
    "region_code", "region_name", "epci_code", "epci_name",
]


def staged_place_names(lists: dict[str, DataFrame]) -> DataFrame:
    """One row per commune with codes and names of all its levels, from ``staged_places``.

    A code that its list does not know is null, like its name."""
    communes = lists["communes"].select(
        "commune_code", "commune_name", F.col("departement_code").alias("_d"),
        F.col("region_code").alias("_r"), F.col("epci_code").alias("_e"),
    )
    joined = lookup_left(
        communes,
        [
            (lists["departments"].select("departement_code", "departement_name"), "_d", "departement_code"),
            (lists["regions"].select("region_code", "region_name"), "_r", "region_code"),
            (lists["epcis"].select("epci_code", "epci_name"), "_e", "epci_code"),
        ],
    )
    return joined.select(*PLACE_COLUMNS)


def staged_places(
    communes: DataFrame, departments: DataFrame, regions: DataFrame, epcis: DataFrame
) -> dict[str, DataFrame]:
    """The typed lists under their own column names, and the commune to postal code pairs."""
    return {
        "regions": regions.select(
            clean_trim("code").alias("region_code"), clean_trim("nom").alias("region_name")
        ),
        "departments": departments.select(
            clean_trim("code").alias("departement_code"),
            clean_trim("nom").alias("departement_name"),
            clean_trim("codeRegion").alias("region_code"),
        ),
        "communes": communes.select(
            clean_trim("code").alias("commune_code"),
            clean_trim("nom").alias("commune_name"),
            clean_trim("codeDepartement").alias("departement_code"),
            clean_trim("codeRegion").alias("region_code"),
            F.to_json("codesPostaux").alias("postal_codes_json"),
            to_whole_number("population").alias("population"),
            clean_trim("codeEpci").alias("epci_code"),
        ),
        "epcis": epcis.select(
            clean_trim("code").alias("epci_code"), clean_trim("nom").alias("epci_name")
        ),
        "postal_codes": explode_codes(
            communes.select(clean_trim("code").alias("commune_code"), "codesPostaux"), "codesPostaux", "code_postal"
        ),
    }
