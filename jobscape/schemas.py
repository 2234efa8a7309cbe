"""Column layouts of the staging tables, and layouts built from a column spec."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import types as T

# The landing-file layouts, as DDL. Names must equal the payload keys.
REGIONS = "nom string, code string"
DEPARTMENTS = "nom string, code string, codeRegion string"
COMMUNES = (
    "nom string, code string, codeDepartement string, siren string, codeEpci string, "
    "codeRegion string, codesPostaux array<string>, population bigint"
)
EPCIS = (
    "nom string, code string, codesDepartements array<string>, codesRegions array<string>, "
    "population bigint"
)
# First offer source: nested records, coded places.
CODED_OFFERS = """
id string not null, intitule string, description string,
dateCreation timestamp, dateActualisation timestamp,
lieuTravail struct<libelle string, latitude double, longitude double, codePostal string, commune string>,
romeCode string, romeLibelle string, appellationlibelle string,
entreprise struct<nom string, description string, entrepriseAdaptee boolean, url string, logo string>,
typeContrat string, typeContratLibelle string, natureContrat string,
experienceExige string, experienceLibelle string, experienceCommentaire string,
langues array<struct<libelle string, exigence string>>,
permis array<struct<libelle string, exigence string>>,
competences array<struct<code string, libelle string, exigence string>>,
salaire struct<libelle string, commentaire string, complement1 string, complement2 string,
  listeComplements array<struct<code string, libelle string>>>,
dureeTravailLibelle string, dureeTravailLibelleConverti string, complementExercice string,
alternance boolean,
contact struct<nom string, coordonnees1 string, coordonnees2 string, coordonnees3 string,
  courriel string, telephone string, urlPostulation string>,
agence struct<courriel string>, nombrePostes bigint, accessibleTH boolean,
deplacementCode string, deplacementLibelle string, qualificationCode string,
qualificationLibelle string, codeNAF string, secteurActivite string, secteurActiviteLibelle string,
qualitesProfessionnelles array<struct<libelle string, description string>>,
trancheEffectifEtab string,
origineOffre struct<origine string, urlOrigine string,
  partenaires array<struct<nom string, url string, logo string>>>,
offresManqueCandidats boolean,
contexteTravail struct<horaires array<string>, conditionsExercice array<string>>,
entrepriseAdaptee boolean, employeurHandiEngage boolean,
formations array<struct<niveauLibelle string, exigence string, codeFormation string,
  domaineLibelle string, commentaire string>>
"""
# Second offer source: places as a list of names, salary as numbers.
NAMED_OFFERS = """
id string, title string, description string, created timestamp, redirect_url string,
adref string, salary_is_predicted string, contract_time string, contract_type string,
salary_min double, salary_max double, latitude double, longitude double,
company struct<display_name string>,
location struct<display_name string, area array<string>>,
category struct<tag string, label string>
"""
# Company register, one row per establishment.
REGISTER = """
siret string, siren string, dateCreationEtablissement string, trancheEffectifsEtablissement string,
codeDepartementEtablissement string,
uniteLegale struct<denominationUniteLegale string, nomUniteLegale string,
  prenomUsuelUniteLegale string, activitePrincipaleUniteLegale string,
  etatAdministratifUniteLegale string, categorieJuridiqueUniteLegale string>,
adresseEtablissement struct<numeroVoieEtablissement string, typeVoieEtablissement string,
  libelleVoieEtablissement string, codePostalEtablissement string,
  libelleCommuneEtablissement string>,
periodesEtablissement array<struct<enseigne1Etablissement string>>
"""

# Type names a column spec may use.
_SPEC_TYPES = {
    "STRING": T.StringType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "BOOL": T.BooleanType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
    "JSON": T.StringType(),
}


def struct_of(layout: str | T.StructType) -> T.StructType:
    """A layout given as DDL or StructType, as StructType."""
    return T.StructType.fromDDL(layout) if isinstance(layout, str) else layout


def schema_from_spec(spec: str | Iterable[Mapping[str, Any]]) -> T.StructType:
    """StructType of a column spec: JSON text or a list of
    ``{name, type, mode, fields}``. REQUIRED columns are not nullable, REPEATED
    ones become arrays, records become structs."""
    columns = json.loads(spec) if isinstance(spec, str) else spec
    return T.StructType([_spec_field(c) for c in columns])


def _spec_field(column: Mapping[str, Any]) -> T.StructField:
    kind = column["type"].upper()
    if kind in ("RECORD", "STRUCT"):
        base: T.DataType = schema_from_spec(column.get("fields", []))
    elif kind in _SPEC_TYPES:
        base = _SPEC_TYPES[kind]
    else:
        raise ValueError(f"column {column['name']}: unknown type {column['type']}")
    mode = column.get("mode", "NULLABLE").upper()
    if mode == "REPEATED":
        base = T.ArrayType(base)
    return T.StructField(column["name"], base, mode != "REQUIRED")


def required_columns(layout: str | T.StructType) -> list[str]:
    """Columns a layout declares as never null."""
    return [f.name for f in struct_of(layout).fields if not f.nullable]
