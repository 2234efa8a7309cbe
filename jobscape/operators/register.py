"""Search in the company register and the columns shown for a hit."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobscape.functions import text

# Labels of the columns a hit can show.
DISPLAY_LABELS = {
    "siret": "SIRET",
    "siren": "SIREN",
    "nom_complet": "Nom / Dénomination",
    "enseigne": "Enseigne",
    "etat": "État Admin.",
    "date_creation": "Date Création",
    "naf": "Code NAF",
    "adresse": "Adresse",
    "cp": "Code Postal",
    "ville": "Ville",
    "effectifs": "Tranche Effectifs",
}
WORD = r"[\p{L}\p{N}]"
# Where the register keeps each criterion.
REGISTER_COLUMNS = {
    "name": ("uniteLegale.denominationUniteLegale", "uniteLegale.nomUniteLegale"),
    "activity": "uniteLegale.activitePrincipaleUniteLegale",
    "city": "adresseEtablissement.libelleCommuneEtablissement",
    "postal_code": "adresseEtablissement.codePostalEtablissement",
    "department": "codeDepartementEtablissement",
    "state": "uniteLegale.etatAdministratifUniteLegale",
    "key": "siret",
}


def phrase(c: Column | str, words: str) -> Column:
    """True where the words stand next to each other, in any case, as whole words."""
    tokens = re.findall(r"\w+", words)
    if not tokens:
        raise ValueError("a phrase needs a word")
    body = rf"[^\p{{L}}\p{{N}}]+".join(tokens)
    return text._col(c).rlike(rf"(?iu)(?<!{WORD}){body}(?!{WORD})")


def starred(c: Column | str, value: str) -> Column:
    """Equality, or a prefix test when the value ends in a star."""
    c = text._col(c)
    return c.startswith(value[:-1]) if value.endswith("*") else c == value


def search_condition(
    columns: Mapping[str, str | Sequence[str]],
    name: str | None = None,
    activity: str | None = None,
    city: str | None = None,
    city_exact: bool = True,
    postal_code: str | None = None,
    department: str | None = None,
    state: str = "all",
) -> Column:
    """All given criteria at once; at least one besides the state is required.

    The name may stand in any of the name columns. The city is compared in upper case;
    with ``city_exact=False`` a trailing star makes it a prefix. A department is compared with its own column,
    in upper case (``2A`` and ``2B`` share the postal codes that start with 20).
    """
    if not any([name, activity, city, postal_code, department]):
        raise ValueError("give at least one search criterion")
    tests = []
    if name:
        names = columns["name"]
        names = [names] if isinstance(names, str) else list(names)
        either = phrase(names[0], name)
        for other in names[1:]:
            either = either | phrase(other, name)
        tests.append(either)
    if activity:
        tests.append(starred(columns["activity"], activity))
    if city:
        wanted = city.upper()
        tests.append(text._col(columns["city"]) == wanted if city_exact else starred(columns["city"], wanted))
    if postal_code:
        tests.append(text._col(columns["postal_code"]) == postal_code)
    if department:
        tests.append(text._col(columns["department"]) == department.upper())
    if state not in ("all", "active", "closed"):
        raise ValueError(f"unknown state {state}")
    if state != "all":
        tests.append(text._col(columns["state"]) == {"active": "A", "closed": "F"}[state])
    all_of = tests[0]
    for test in tests[1:]:
        all_of = all_of & test
    return all_of


def register_search(
    register: DataFrame,
    columns: Mapping[str, str | Sequence[str]] = REGISTER_COLUMNS,
    limit: int | None = None,
    **criteria,
) -> DataFrame:
    """Rows meeting the criteria; the first ``limit`` by key (a top-k, not a sort)."""
    hits = register.filter(search_condition(columns, **criteria))
    return hits if limit is None else hits.orderBy(columns["key"]).limit(limit)


def establishment_rows(register: DataFrame) -> DataFrame:
    """Register records as the flat rows a search shows; every column is text."""
    unit, place = "uniteLegale", "adresseEtablissement"
    rows = register.select(
        F.col("siret"),
        F.col("siren"),
        text.company_name(
            f"{unit}.denominationUniteLegale", f"{unit}.prenomUsuelUniteLegale", f"{unit}.nomUniteLegale"
        ).alias("nom_complet"),
        text.first_period_field("periodesEtablissement", "enseigne1Etablissement").alias("enseigne"),
        text.state_label(f"{unit}.etatAdministratifUniteLegale").alias("etat"),
        F.col("dateCreationEtablissement").alias("date_creation"),
        F.col(f"{unit}.activitePrincipaleUniteLegale").alias("naf"),
        text.address_line(
            f"{place}.numeroVoieEtablissement", f"{place}.typeVoieEtablissement", f"{place}.libelleVoieEtablissement"
        ).alias("adresse"),
        F.col(f"{place}.codePostalEtablissement").alias("cp"),
        F.col(f"{place}.libelleCommuneEtablissement").alias("ville"),
        text.default_text("trancheEffectifsEtablissement").alias("effectifs"),
    )
    return rows.select(*[text.drop_none_words(c).alias(c) for c in rows.columns])


def display_columns(df: DataFrame, columns: Sequence[str], labels: Mapping[str, str] = DISPLAY_LABELS) -> DataFrame:
    """The chosen columns under their labels."""
    return df.select(*columns).withColumnsRenamed({c: labels[c] for c in columns if c in labels})
