"""Typed slices of the first offer source: offer, place, employer, salary.

These follow a written specification of the tables, not existing models.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobscape.functions.text import null_if_blank, presence_flag, to_id_string

TRIM = "unicode"
OFFER = {
    "job_title": "intitule",
    "job_description": "description",
    "rome_code": "romeCode",
    "rome_label": "romeLibelle",
    "appellation_label": "appellationlibelle",
    "created_at": "dateCreation",
    "updated_at": "dateActualisation",
    "contract_type": "typeContrat",
    "contract_type_label": "typeContratLibelle",
    "contract_nature": "natureContrat",
    "qualification_code": "qualificationCode",
    "qualification_label": "qualificationLibelle",
    "experience_required_code": "experienceExige",
    "experience_required_label": "experienceLibelle",
    "is_alternance": "alternance",
    "post_count": "nombrePostes",
}
LOCATION = {
    "workplace_label": "lieuTravail.libelle",
    "postal_code": "lieuTravail.codePostal",
    "commune_code": "lieuTravail.commune",
    "latitude": "lieuTravail.latitude",
    "longitude": "lieuTravail.longitude",
}
EMPLOYER = {
    "employer_name": "entreprise.nom",
    "employer_description": "entreprise.description",
    "naf_code": "codeNAF",
    "activity_sector_code": "secteurActivite",
    "activity_sector_label": "secteurActiviteLibelle",
    "employee_size_range": "trancheEffectifEtab",
    "is_adapted_company": "entreprise.entrepriseAdaptee",
}
SALARY = {
    "salary_label": "salaire.libelle",
    "salary_comment": "salaire.commentaire",
    "salary_extra_1": "salaire.complement1",
    "salary_extra_2": "salaire.complement2",
}


def _slice(offers: DataFrame, columns: dict[str, str], key: str = "id") -> DataFrame:
    """Renamed columns; text is trimmed and blank text is null."""
    renamed = offers.select(to_id_string(key).alias("offer_id"), *[F.col(s).alias(o) for o, s in columns.items()])
    return renamed.select(
        *[null_if_blank(f.name, TRIM).alias(f.name) if f.dataType.simpleString() == "string" else f.name for f in renamed.schema.fields]
    )


def stg_offers(offers: DataFrame, columns: dict[str, str] = OFFER, key: str = "id") -> DataFrame:
    return _slice(offers, columns, key)


def stg_locations(offers: DataFrame, columns: dict[str, str] = LOCATION, key: str = "id") -> DataFrame:
    return _slice(offers, columns, key)


def stg_employers(offers: DataFrame, columns: dict[str, str] = EMPLOYER, key: str = "id") -> DataFrame:
    return _slice(offers, columns, key)


def stg_salaries(offers: DataFrame, columns: dict[str, str] = SALARY, key: str = "id") -> DataFrame:
    return _with_salary_text(_slice(offers, columns, key), list(columns))


def stg_whole(
    offers: DataFrame,
    offer: dict[str, str] = OFFER,
    location: dict[str, str] = LOCATION,
    employer: dict[str, str] = EMPLOYER,
    salary: dict[str, str] = SALARY,
    key: str = "id",
) -> DataFrame:
    """All four slices side by side. Later steps start here: the slices of one offer stand
    in one source row, so nothing has to be joined back by offer."""
    return _with_salary_text(_slice(offers, {**offer, **location, **employer, **salary}, key), list(salary))


def _with_salary_text(df: DataFrame, texts: list[str]) -> DataFrame:
    """All salary texts as one, and what there is: ``label``, ``text`` or ``none``."""
    raw = F.nullif(F.concat_ws(" | ", *texts), F.lit(""))
    flag = F.when(presence_flag(texts[0]) == 1, "label").when(raw.isNotNull(), "text").otherwise("none")
    return df.withColumns({"salary_raw_text": raw, "salary_quality_flag": flag})


def raw_offers(lines: DataFrame, run_id: str, ingested_at, source_system: str) -> DataFrame:
    """The payload table: one row per landed offer and ingestion, nothing lost.

    ``lines`` comes from ``raw_with_lineage``; run id and ingestion time are given."""
    return lines.withColumns(
        {
            "run_id": F.lit(run_id),
            "ingestion_timestamp": F.lit(ingested_at).cast("timestamp"),
            "source_system": F.lit(source_system),
        }
    )
