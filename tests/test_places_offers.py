from __future__ import annotations

import pytest

from jobscape.operators import quality
from jobscape.plans import daily, geo, offers
from tests import fixtures


@pytest.fixture(scope="module")
def places(spark):
    return geo.communes_by_postal_code(*fixtures.place_lists(spark)).cache()


def test_one_row_per_commune_and_postal_code(places, rows):
    assert rows(places.select("commune_code", "code_postal", "departement_nom", "region_nom", "epci_nom", "population")) == sorted(
        [
            ("C1", "10001", "Ainval", "Norderie", "Métropole A", 500),
            ("C1", "10002", "Ainval", "Norderie", "Métropole A", 500),
            ("C2", "10100", "Ainval", "Norderie", None, 20),
            ("C3", "20100", "Basmont", "Norderie", "CC B", 30),
            ("C6", "99100", None, "Norderie", "CC B", 7),
        ],
        key=repr,
    )


def test_name_index(places, rows):
    index = geo.communes_by_name(places)
    assert rows(index.select("commune_nom_upper", "departement_nom_upper", "code_postal")) == sorted(
        [
            ("LYONVILLE", "AINVAL", "10002"),
            ("SAINT-MIR", "AINVAL", "10100"),
            ("SAINT-MIR", "BASMONT", "20100"),
            ("ÉLOI", None, "99100"),
        ],
        key=repr,
    )


def test_name_index_mixes_values(spark):
    from jobscape.operators.geo import name_index

    df = spark.createDataFrame([("a", "1", "y"), ("A", "2", "x")], "n string, code string, other string")
    assert tuple(name_index(df, {"k": "n"}, ["code", "other"]).first()) == ("A", "2", "y")


def test_first_code_keeps_every_commune(spark, rows):
    got = rows(geo.communes_first_code(*fixtures.place_lists(spark)).select("commune_nom", "code_postal"))
    assert len(got) == 7 and ("Videcourt", None) in got and ("Lyonville", "10002") in got


def test_coded_offers(spark, places, rows):
    got = rows(
        offers.coded_offers(fixtures.coded_offers(spark), places).select(
            "offer_id", "code_postal", "numero_departement", "employer_name", "has_salary_info", "is_alternance"
        )
    )
    assert got == sorted(
        [
            ("O1", "10001", "01", "Acmé", 1, 0),
            ("O1", "10002", "01", "Acmé", 1, 0),
            ("O2", "10100", "01", "Acmé", 0, 1),
            ("O7", "99100", None, "Acmé", 0, 1),
        ],
        key=repr,
    )


def test_coded_offers_checks(spark, places, rows):
    built = offers.coded_offers(fixtures.coded_offers(spark), places)
    assert rows(quality.check_unique(built, "offer_id")) == [("O1", 2)]
    assert rows(daily.missing_department(built).select("offer_id")) == [("O7",)]


def test_one_row_per_offer_switch(spark, places, rows):
    got = offers.coded_offers(fixtures.coded_offers(spark), places, one_row_per_offer=True)
    assert rows(got.select("offer_id", "code_postal")) == [("O1", "10001"), ("O2", "10100"), ("O7", "99100")]


NAMED = [
    ("A1", "10002", "01", 1),
    ("A2", "10100", "01", 0),
    ("A2", "20100", "02", 0),
    ("A4", "20100", "02", 1),
    ("A7", "99100", None, 0),
]


def test_named_offers(spark, places, rows):
    got = offers.named_offers(fixtures.named_offers(spark), places)
    assert rows(got.select("offer_id", "code_postal", "numero_departement", "has_salary_info")) == NAMED


def test_named_offers_from_label(spark, places, rows):
    """The label names what the list names, but a list of two has France as its department."""
    got = offers.named_offers(fixtures.named_offers(spark), places, place_from="label")
    assert rows(got.select("offer_id", "code_postal")) == [("A1", "10002"), ("A4", "20100")]


def test_offer_view_keeps_unmatched(spark, rows):
    got = offers.offer_view(fixtures.coded_offers(spark), geo.commune_names(*fixtures.place_lists(spark)))
    # O3 and O4 name no commune; the code of O1 is compared as it stands; C1 is listed twice.
    assert rows(got.select("offre_id", "departement_nom", "region_nom")) == sorted(
        [
            ("O1", None, None),
            ("O2", "Ainval", "Norderie"),
            ("O5", "Basmont", "Norderie"),
            ("O6", None, None),
            ("O7", None, "Norderie"),
        ],
        key=repr,
    )


def test_staged_places(spark, rows):
    lists = geo.staged_places(*fixtures.place_lists(spark))
    assert rows(lists["postal_codes"].distinct())[:2] == [("C1", "10001"), ("C1", "10002")]
    assert lists["communes"].filter("commune_code = 'C2'").first()["postal_codes_json"] == '["10100"]'


def test_hot_commune_joins_without_loss(spark, places):
    """A third of the offers in one commune; every one of them must come out, twice."""
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one = fixtures.coded_offers(spark).filter("id in ('O1', 'O2', 'O7')")
        many = one.select("*", F.explode(F.sequence(F.lit(1), F.lit(2000)))).drop("col")
        assert offers.coded_offers(many, places).count() == 2000 * 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
