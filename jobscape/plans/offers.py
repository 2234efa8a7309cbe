"""Offers of both sources with their place: the common offer model."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobscape.functions.text import (
    area_city,
    area_department,
    clean_trim,
    is_not_blank,
    keyword_flag,
    label_city,
    label_department,
    null_if_blank,
    presence_flag,
    to_id_string,
)
from jobscape.operators.geo import join_by_code, join_by_name, one_row_per_key
from jobscape.plans.geo import communes_by_name

APPRENTICE_WORD = "ALTERNANCE"
TRIM = "unicode"


def coded_offers(offers: DataFrame, places: DataFrame, one_row_per_offer: bool = False) -> DataFrame:
    """Offers of the first source joined to their commune by code.

    Offers without a known commune drop out. An offer in a commune with several postal
    codes has one row for each; ``one_row_per_offer`` keeps the smallest postal code.
    """
    o = offers.select(
        to_id_string("id").alias("offer_id"),
        F.col("intitule").alias("job_title"),
        F.col("description").alias("job_description"),
        F.col("dateCreation").alias("created_at"),
        F.col("dateActualisation").alias("updated_at"),
        F.col("typeContrat").alias("contract_type"),
        F.col("experienceExige").alias("experience_required"),
        null_if_blank("entreprise.nom", TRIM).alias("employer_name"),
        null_if_blank("entreprise.description", TRIM).alias("employer_description"),
        null_if_blank("lieuTravail.commune", TRIM).alias("_commune"),
        null_if_blank("salaire.libelle", TRIM).alias("salary_label"),
        null_if_blank("salaire.commentaire", TRIM).alias("salary_comment"),
        null_if_blank("codeNAF", TRIM).alias("naf_code"),
        F.col("secteurActiviteLibelle").alias("industry_label"),
    ).filter("_commune is not null")
    joined = join_by_code(o, places, "_commune", "commune_code").select(
        "offer_id", "job_title", "job_description", "created_at", "updated_at", "contract_type",
        "experience_required", "code_postal",
        F.col("commune_nom").alias("nom_commune"),
        F.col("departement_code").alias("numero_departement"),
        F.col("departement_nom").alias("nom_departement"),
        F.col("region_nom").alias("nom_region"),
        F.col("epci_nom").alias("nom_epci"),
        "employer_name", "employer_description", "naf_code", "industry_label", "salary_label", "salary_comment",
        presence_flag("salary_label").alias("has_salary_info"),
        keyword_flag("job_title", APPRENTICE_WORD).alias("is_alternance"),
    )
    return one_row_per_key(joined, "offer_id", "code_postal") if one_row_per_offer else joined


# Rows are compared on all of these before the place is read from them.
NAMED_COLUMNS = {
    "job_title": "title",
    "job_description": "description",
    "created_at": "created",
    "redirect_url": "redirect_url",
    "salary_is_predicted": "salary_is_predicted",
    "contract_time": "contract_time",
    "contract_type": "contract_type",
    "salary_min": "salary_min",
    "salary_max": "salary_max",
    "latitude": "latitude",
    "longitude": "longitude",
    "employer_name": "company.display_name",
    "location_display_name": "location.display_name",
    "location_area": "location.area",
    "category_label": "category.label",
}


def named_offers(
    offers: DataFrame, places: DataFrame, place_from: str = "area", one_row_per_offer: bool = False
) -> DataFrame:
    """Offers of the second source joined to their commune by name.

    City and department come from the list of place names (``area``) or from the label
    before and after its first comma (``label``). Without a department an offer joins
    every commune of that name.
    """
    distinct = offers.select(
        to_id_string("id").alias("offer_id"), *[F.col(src).alias(out) for out, src in NAMED_COLUMNS.items()]
    ).distinct()
    if place_from == "area":
        city, department = area_city("location_area"), area_department("location_area")
    elif place_from == "label":
        city, department = label_city("location_display_name"), label_department("location_display_name")
    else:
        raise ValueError(f"place_from must be area or label, not {place_from}")
    a = distinct.withColumns({"_city": city, "_department": department})
    joined = join_by_name(
        a, communes_by_name(places), "_city", "_department", "commune_nom_upper", "departement_nom_upper"
    ).select(
        "offer_id", "job_title", "job_description", "created_at", "contract_time", "contract_type",
        "salary_min", "salary_max", "employer_name", "category_label", "code_postal",
        F.col("commune_nom").alias("nom_commune"),
        F.col("departement_code").alias("numero_departement"),
        F.col("departement_nom").alias("nom_departement"),
        F.col("region_nom").alias("nom_region"),
        F.col("epci_nom").alias("nom_epci"),
        "latitude", "longitude",
        F.col("location_display_name").alias("original_location"),
        presence_flag("salary_min", "salary_max").alias("has_salary_info"),
        keyword_flag("job_title", APPRENTICE_WORD).alias("is_alternance"),
    )
    return one_row_per_key(joined, "offer_id", "code_postal") if one_row_per_offer else joined


# Output column to flat source column of the offer view; all trimmed text.
VIEW_TEXT = {
    "offre_id": "id",
    "intitule": "intitule",
    "description": "description",
    "rome_code": "romeCode",
    "rome_libelle": "romeLibelle",
    "appellation_libelle": "appellationlibelle",
    "commune_code": "lieuTravail.commune",
    "code_postal": "lieuTravail.codePostal",
    "lieu_libelle": "lieuTravail.libelle",
    "entreprise_nom": "entreprise.nom",
    "type_contrat_code": "typeContrat",
    "type_contrat_libelle": "typeContratLibelle",
    "nature_contrat": "natureContrat",
    "date_creation": "dateCreation",
    "date_actualisation": "dateActualisation",
    "secteur_activite_code": "secteurActivite",
    "secteur_activite_libelle": "secteurActiviteLibelle",
    "salaire_libelle": "salaire.libelle",
    "duree_travail_libelle": "dureeTravailLibelle",
    "duree_travail_libelle_converti": "dureeTravailLibelleConverti",
    "qualification_code": "qualificationCode",
    "qualification_libelle": "qualificationLibelle",
    "origine_offre_code": "origineOffre.origine",
    "origine_offre_url": "origineOffre.urlOrigine",
}
VIEW_AS_IS = {"nombre_postes": "nombrePostes", "alternance": "alternance", "accessible_th": "accessibleTH"}


def offer_view(offers: DataFrame, names: DataFrame) -> DataFrame:
    """Offers that name a commune, with place names where the commune is known.

    ``names`` is the kept result of ``commune_names``."""
    o = offers.select(
        F.col("lieuTravail.commune").alias("_commune"),
        *[clean_trim(F.col(src).cast("string")).alias(out) for out, src in VIEW_TEXT.items()],
        *[F.col(src).alias(out) for out, src in VIEW_AS_IS.items()],
    ).filter(is_not_blank("_commune"))
    return o.join(names, F.col("_commune") == F.col("code"), "left").drop("_commune", "code")
