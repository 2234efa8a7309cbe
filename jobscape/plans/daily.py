"""The layers in order: landed files to staging, places, offers, checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from jobscape import schemas
from jobscape.operators import quality
from jobscape.operators.dedupe import require_keys
from jobscape.plans.geo import communes_by_postal_code
from jobscape.plans.offers import coded_offers, named_offers
from jobscape.sinks.tables import layer_table, materialize_table
from jobscape.sources.files import read_ndjson

# Landing folder, layout and handling of unknown keys per staging table.
STAGING = {
    "regions": (schemas.REGIONS, "reject"),
    "departements": (schemas.DEPARTMENTS, "reject"),
    "communes": (schemas.COMMUNES, "reject"),
    "epcis": (schemas.EPCIS, "reject"),
    "coded_offers": (schemas.CODED_OFFERS, "ignore"),
    "named_offers": (schemas.NAMED_OFFERS, "ignore"),
}


def load_staging(spark: SparkSession, landing: Mapping[str, str], layer: str) -> dict[str, DataFrame]:
    """Typed staging tables from their landing patterns; a full rebuild of each.

    Files are read once: a null in a required column fails the load itself.
    """
    for name, path in landing.items():
        layout, unknown = STAGING[name]
        rows = read_ndjson(spark, path, layout, unknown)
        materialize_table(require_keys(rows, schemas.required_columns(layout)), layer_table(layer, name))
    return {name: spark.table(layer_table(layer, name)) for name in landing}


def build_offers(spark: SparkSession, staged: Mapping[str, DataFrame], layer: str) -> dict[str, DataFrame]:
    """The place table and both offer tables. Places are written first: their size is then
    known to the joins that read them."""
    places = communes_by_postal_code(
        staged["communes"], staged["departements"], staged["regions"], staged["epcis"]
    )
    materialize_table(places, layer_table(layer, "communes"))
    places = spark.table(layer_table(layer, "communes"))
    materialize_table(coded_offers(staged["coded_offers"], places), layer_table(layer, "coded_offers"))
    materialize_table(named_offers(staged["named_offers"], places), layer_table(layer, "named_offers"))
    return {n: spark.table(layer_table(layer, n)) for n in ("communes", "coded_offers", "named_offers")}


def checks(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The failing rows of every declared check."""
    places, coded, named = tables["communes"], tables["coded_offers"], tables["named_offers"]
    return {
        "communes.commune_code not null": quality.check_not_null(places, "commune_code"),
        "communes.code_postal not null": quality.check_not_null(places, "code_postal"),
        "communes.departement_code not null": quality.check_not_null(places, "departement_code"),
        "coded_offers.offer_id not null": quality.check_not_null(coded, "offer_id"),
        "coded_offers.offer_id unique": quality.check_unique(coded, "offer_id"),
        "named_offers.offer_id not null": quality.check_not_null(named, "offer_id"),
        "named_offers.offer_id unique": quality.check_unique(named, "offer_id"),
        "coded_offers have a department": missing_department(coded),
    }


def missing_department(offers: DataFrame) -> DataFrame:
    """Offers whose commune has no known department."""
    return quality.check_query(
        offers, offers["nom_departement"].isNull(), ["offer_id", "code_postal", "nom_departement"]
    )
