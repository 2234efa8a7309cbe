"""Staged slices, employers and answer tables on hand-made offers."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from jobscape import schemas
from jobscape.operators import matching, quality
from jobscape.plans import employers as emp, geo, marts, staging
from jobscape.sinks.tables import settle
from jobscape.sources.files import raw_with_lineage


def offers_df(spark):
    layout = schemas.struct_of(schemas.CODED_OFFERS)

    def record(ident, employer, commune, label, day, contract, complement=None):
        values = dict.fromkeys(layout.names)
        values.update(
            id=ident, intitule="Alternance" if contract == "CDD" else "Dev", typeContrat=contract, codeNAF="62.01Z",
            dateCreation=dt.datetime(2026, 4, day, 10), dateActualisation=dt.datetime(2026, 4, day + 1, 10),
            entreprise=(employer, None, False, None, None), lieuTravail=("l", 1.0, 2.0, "10001", commune),
            salaire=(label, None, complement, None, None), trancheEffectifEtab="10",
        )
        return tuple(values[n] for n in layout.names)

    return spark.createDataFrame(
        [
            record("O1", "Acme SAS", "C1", "Annuel de 30000.0 Euros à 40000.0 Euros sur 12.0 mois", 1, "CDI"),
            record("O2", " ACME ", "C1", "Mensuel de 2000.0 Euros sur 12.0 mois", 1, "CDD"),
            record("O3", "Acmé", "C2", None, 2, "CDI", "Prime"),
            record("O4", None, "ZZ", " ", 8, "CDI"),
            record("O5", "Betta", "C3", None, 8, "CDI"),
        ],
        layout,
    )


@pytest.fixture
def staged(spark):
    return staging.stg_whole(offers_df(spark))


@pytest.fixture
def places(spark):
    from tests import fixtures

    communes, departments, regions, epcis = fixtures.place_lists(spark)
    return geo.staged_place_names(geo.staged_places(communes.distinct(), departments, regions, epcis))


@pytest.fixture
def entries(spark):
    stock = spark.createDataFrame(
        [
            ("00000000000009", "9", None, "11", "75", ("ACME", None, None, "62.01Z", "A", "5710"), (None, None, None, "10001", None), [("Chez Acme",)]),
            ("00000000000007", "7", None, None, "75", ("Beta", None, None, None, "A", None), (None, None, None, "10001", None), []),
            ("00000000000001", "1", None, None, "75", ("ACME", None, None, None, "A", None), (None, None, None, "75001", None), []),
        ],
        schemas.REGISTER,
    )
    return emp.register_entries(stock)


def test_slices(spark, rows):
    o = offers_df(spark)
    assert staging.stg_offers(o).columns[:3] == ["offer_id", "job_title", "job_description"]
    assert len(staging.stg_offers(o).columns) == 17
    assert rows(staging.stg_employers(o).select("employer_name"))[0] == ("ACME",)
    assert rows(staging.stg_locations(o).select("postal_code", "latitude").distinct()) == [("10001", 1.0)]
    got = staging.stg_salaries(o).select("offer_id", "salary_quality_flag", "salary_raw_text").filter("offer_id > 'O2'")
    assert rows(got) == [("O3", "text", "Prime"), ("O4", "none", None), ("O5", "none", None)]


def test_candidates_and_matches(staged, entries, rows):
    candidates = emp.int_employer_candidates(staged)
    assert rows(candidates.select("normalized_employer_name", "commune_code", "offer_count")) == [
        ("ACME", "C1", 2), ("ACME", "C2", 1), ("BETTA", "C3", 1),
    ]
    matches = emp.raw_matches(candidates, entries, "run-1")
    got = emp.stg_register_matches(matches).select(
        "commune_code", "siret", "legal_category", "trade_name", "match_method", "match_confidence", "match_status"
    )
    assert rows(got) == [
        ("C1", "00000000000009", "5710", "Chez Acme", "exact", 1.0, "matched"),
        ("C2", "00000000000009", "5710", "Chez Acme", "exact", 1.0, "matched"),
        ("C3", "00000000000007", None, None, "fuzzy", 0.8, "matched"),
    ]
    linked = emp.int_offer_employers(staged, matches)
    assert rows(linked.select("offer_id", "siren", "match_status")) == [
        ("O1", "9", "matched"), ("O2", "9", "matched"), ("O3", "9", "matched"), ("O4", None, "unmatched"), ("O5", "7", "matched"),
    ]
    assert rows(quality.check_unique(linked, "offer_id")) == []
    searched = emp.search_results(candidates, entries, "run-1")
    assert rows(searched.select("search_term", "commune_code", "n_found")) == [("ACME", "C1", 1), ("ACME", "C2", 1), ("BETTA", "C3", 0)]


def test_offers_without_employer_stay_out_of_the_join(spark, staged, entries, rows):
    kept = settle(emp.raw_matches(emp.int_employer_candidates(staged), entries, "run-1"), "matches")
    linked = emp.with_employers(staged, kept).select("offer_id", "siren", "match_status")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = linked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Two sides of the join are moved, and no hash of the candidate is made for it.
    assert plan.count("Exchange hashpartitioning") == 2 and "sha2" not in plan and "Union" in plan
    by_id = emp.with_employers(staged, kept.select("employer_candidate_id", "siren", "siret", "legal_name", "match_confidence", "match_status"))
    assert rows(by_id.select("offer_id", "siren", "match_status")) == rows(linked)


def test_missing_places_and_odd_names_find_their_match(spark, rows):
    offers = spark.createDataFrame(
        [("1", "Acme", None), ("2", "acme SA", ""), ("3", "--", None), ("4", "  ", "7"), ("5", None, "7"), ("6", "Acme", "7"), ("6", "Acme", "7")],
        "offer_id string, employer_name string, postal_code string",
    )
    found = emp.int_employer_candidates(offers, ["postal_code"])
    assert rows(found.select("normalized_employer_name", "postal_code", "offer_count")) == sorted(
        [("ACME", None, 1), ("ACME", "", 1), ("ACME", "7", 2)], key=repr
    )
    kept = found.withColumns({c: F.coalesce("postal_code", F.lit("none")) for c in ("siren", "siret", "legal_name")}).withColumns(
        {"match_confidence": F.lit(1.0), "match_status": F.lit("matched")}
    )
    got = emp.int_offer_employers(offers, kept, ["postal_code"])
    assert rows(got.select("offer_id", "siret", "match_status")) == sorted(
        [
            ("1", "none", "matched"), ("2", "", "matched"), ("3", None, "unmatched"), ("4", None, "unmatched"), ("5", None, "unmatched"),
            ("6", "7", "matched"), ("6", "7", "matched"),
        ],
        key=repr,
    )


def test_names_are_cut_only_where_the_register_has_entries(spark, rows, monkeypatch):
    """Open names of a place without entries are left out before they are cut into forms."""
    kept = {}
    monkeypatch.setattr(matching, "settle", lambda df, label: kept.setdefault(label, settle(df, label)))
    wanted = spark.createDataFrame([("ACME", "1"), ("BETA", "1"), ("GAMMA", "2"), ("ACME", None)], "normalized_employer_name string, postal_code string")
    register = spark.createDataFrame(
        [("02", "2", "Acme SA", "1"), ("01", "1", "ACME", "1"), ("03", "3", "Bety", "1"), ("04", "4", "Gamma", "3"), ("05", "5", "Acme", None)],
        "siret string, siren string, legal_name string, postal_code string",
    )
    got = matching.match_employers(wanted, register).select("normalized_employer_name", "postal_code", "siret", "match_method")
    assert rows(got) == sorted([("ACME", "1", "01", "exact"), ("BETA", "1", "03", "fuzzy"), ("GAMMA", "2", None, None), ("ACME", None, None, None)], key=repr)
    assert rows(kept["open-names"]) == [("BETA", "1")]


def test_enriched_has_one_row_per_offer(staged, places, entries, rows):
    matches = emp.raw_matches(emp.int_employer_candidates(staged), entries, "run-1")
    got = marts.int_offers_enriched(staged, places, matches)
    assert rows(got.select("offer_id", "departement_code", "region_name", "epci_name", "siren")) == sorted(
        [
            ("O1", "01", "Norderie", "Métropole A", "9"), ("O2", "01", "Norderie", "Métropole A", "9"),
            ("O3", "01", "Norderie", None, "9"), ("O4", None, None, None, None), ("O5", "02", "Norderie", "CC B", "7"),
        ],
        key=repr,
    )
    assert rows(marts.mart_offers(got, ["offer_id"])) == [(f"O{i}",) for i in range(1, 6)]


def test_places_mart(staged, places, rows):
    offers = marts.with_places(staged, places)
    got = marts.mart_places(
        offers, ["region_name", "departement_code"], "created_at", "employer_name",
        F.col("contract_type") == "CDI", F.col("job_title") == "Alternance", F.col("salary_label").isNotNull(),
    )
    april = dt.date(2026, 4, 1)
    assert rows(got) == sorted(
        [
            ("region_name", "Norderie", None, april, 4, 4, 0.75, 0.25, 0.5),
            ("region_name", None, None, april, 1, 0, 1.0, 0.0, 0.0),
            ("departement_code", "Norderie", "01", april, 3, 3, 0.6667, 0.3333, 0.6667),
            ("departement_code", "Norderie", "02", april, 1, 1, 1.0, 0.0, 0.0),
            ("departement_code", None, None, april, 1, 0, 1.0, 0.0, 0.0),
        ],
        key=repr,
    )


def test_places_mart_never_repeats_rows_per_level(staged, places):
    offers = marts.with_places(staged, places)
    got = marts.mart_places(
        offers, ["region_name", "departement_code", "commune_code"], "created_at", "employer_name",
        F.lit(True), F.lit(True), F.lit(True),
    )
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()


def test_places_mart_adds_up_slices_and_null_zones(spark, rows):
    year = dt.date(2026, 1, 1)
    states = spark.createDataFrame(
        [("R", "1", year, "a", 2, 1), ("R", "1", year, "a", 1, 0), ("R", "2", year, "a", 1, 1), ("R", None, year, "b", 1, 0), (None, None, year, None, 3, 3)],
        "region string, dep string, period date, company string, n bigint, n_permanent bigint",
    ).withColumns({"n_apprentice": F.lit(0), "n_salaried": F.lit(0)})
    got = marts.places_from_states(states, ["region", "dep"], "company").drop("apprentice_share", "salary_share")
    assert rows(got) == sorted(
        [
            ("region", "R", None, year, 5, 2, 0.4), ("region", None, None, year, 3, 0, 1.0), ("dep", "R", "1", year, 3, 1, 0.3333),
            ("dep", "R", "2", year, 1, 1, 1.0), ("dep", "R", None, year, 1, 1, 0.0), ("dep", None, None, year, 3, 0, 1.0),
        ],
        key=repr,
    )


def test_employer_mart(staged, places, rows):
    offers = marts.with_places(staged, places).withColumn("siren", F.when(F.col("employer_name").ilike("acm%"), "9"))
    got = marts.mart_employers(offers, "siren", "employer_name", "departement_code", "activity_sector_label", "employee_size_range")
    assert rows(got.select("employer_key", "n_offers", "n_zones", "zones", "size")) == [("9", 3, 1, "01", "10"), ("Betta", 1, 1, "02", "10")]


def test_employer_mart_adds_up_zones_once(staged, places):
    offers = marts.with_places(staged, places)
    got = marts.mart_employers(offers, "employer_name", "employer_name", "departement_code", "activity_sector_label", "employee_size_range")
    assert len([k for k in aggregates(got) if "zone" in k or "departement_code" in k]) == 2


def test_salary_mart(staged, rows):
    got = marts.mart_salaries(staged, "salary_label", ["contract_type"])
    figures = got.drop("salary_text")
    assert rows(figures) == [("CDD", 1, 1, 1, 24000.0, 24000.0, 24000.0), ("CDI", 4, 1, 1, 30000.0, 40000.0, 35000.0)]
    assert rows(got.select("contract_type", "salary_text"))[0] == ("CDD", "Mensuel de 2000.0 Euros sur 12.0 mois")


def test_trend_mart(staged, rows):
    got = marts.mart_trend(staged, "created_at", "updated_at", "employer_name", unit="week")
    assert rows(got) == [(dt.date(2026, 3, 30), 3, 3, 3), (dt.date(2026, 4, 6), 2, 2, 1)]


def aggregates(df):
    """The grouping keys of every aggregate of the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"Aggregate\(keys?=\[([^\]]*)", plan)]


def test_trend_holds_each_company_once_on_either_side_of_the_shuffle(staged):
    keys = aggregates(marts.mart_trend(staged, "created_at", "updated_at", "employer_name"))
    assert len([k for k in keys if "company" in k]) == 2


def test_trend_counts_companies_of_several_slices_once(spark, rows):
    day = dt.date(2026, 4, 1)
    states = spark.createDataFrame(
        [(day, "a", 2, 1), (day, "a", 1, 0), (day, "b", 0, 3), (day, None, 4, 0), (dt.date(2026, 4, 2), "b", 0, 1)],
        "period date, company string, n_new bigint, n_updated bigint",
    )
    assert rows(marts.trend_from_states(states)) == [(day, 7, 4, 1), (dt.date(2026, 4, 2), 0, 1, 0)]


def test_raw_payload_table(spark, rows):
    lines = spark.createDataFrame([("f.ndjson", '{"id": "O1"}')], "source_file string, raw_json string")
    raw = staging.raw_offers(raw_with_lineage(lines), "run-1", "2026-04-06 07:00:00", "first")
    assert raw.columns == ["offer_id", "source_file", "raw_json", "run_id", "ingestion_timestamp", "source_system"]
    assert raw.first()["ingestion_timestamp"] == dt.datetime(2026, 4, 6, 7)


def test_accepted_values(staged, rows):
    assert rows(quality.check_accepted_values(staged, "contract_type", ["CDI"])) == [("CDD", 1)]
    with pytest.raises(quality.CheckFailed):
        quality.require(quality.check_accepted_values(staged, "contract_type", ["CDI"]), "contract")
    assert rows(quality.check_required_columns(staged.withColumn("x", F.lit(None)), "x string not null").select("missing_column").distinct()) == [("x",)]
