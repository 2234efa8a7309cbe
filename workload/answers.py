"""Staged offers, employers and their register match, and the answer tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobscape.operators import matching, quality, reports
from jobscape.plans import employers as emp, geo as plans_geo, marts, staging
from jobscape.session import scratch_path
from jobscape.sinks import checked
from jobscape.sinks.tables import settle
from workload.tables import (
    CODED_SQL,
    COMMUNES_SQL,
    EMPLOYERS_SQL,
    coded_offers,
    employer_rows,
    place_lists,
    register_rows,
    table,
    text,
)

# Slices of the offer stand-in: output column to source column.
OFFER = {"job_title": "intitule", "created_at": "dateCreation", "updated_at": "dateActualisation", "contract_type": "typeContrat"}
LOCATION = {"commune_code": "lieuTravail.commune"}
EMPLOYER = {"employer_name": "entreprise.nom", "naf_code": "codeNAF", "activity_sector_label": "secteurActiviteLibelle"}
SALARY = {"salary_label": "salaire.libelle", "salary_comment": "salaire.commentaire"}


def staged(spark, sf):
    return staging.stg_whole(coded_offers(spark, sf), OFFER, LOCATION, EMPLOYER, SALARY)


def stg_offer_slice(spark, sf):
    rows = staging.stg_offers(coded_offers(spark, sf), OFFER)
    return rows.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("created_at", "updated_at")})


def full_offers(spark, sf):
    """Line items as offers with every field the staged slices read; some texts are blank or padded."""
    part, supplier, line = text("l_partkey"), text("l_suppkey"), text("l_linenumber")
    blank = lambda when, value: F.when(when, F.lit("  ")).otherwise(F.concat(F.lit(" "), value, F.lit("\t")))
    even, small = F.col("l_suppkey") % 2 == 0, F.col("l_quantity") < 10
    return (
        table(spark, sf, "lineitem").select(
            F.concat_ws("-", text("l_orderkey"), line, part, supplier, F.date_format("l_shipdate", "yyyyMMdd"), text("l_tax")).alias("id"),
            F.concat(F.lit("Poste "), part).alias("intitule"), blank(small, part).alias("description"),
            F.concat(F.lit("M"), supplier).alias("romeCode"), blank(even, supplier).alias("romeLibelle"), F.col("l_returnflag").alias("appellationlibelle"),
            F.col("l_shipdate").alias("dateCreation"), F.date_add("l_shipdate", 3).alias("dateActualisation"),
            F.col("l_linestatus").alias("typeContrat"), blank(~even, F.col("l_linestatus")).alias("typeContratLibelle"), F.lit("E1").alias("natureContrat"),
            line.alias("qualificationCode"), blank(small, line).alias("qualificationLibelle"), F.lit("D").alias("experienceExige"),
            F.concat(line, F.lit(" an(s)")).alias("experienceLibelle"), (F.col("l_returnflag") == "A").alias("alternance"),
            F.col("l_linenumber").cast("int").alias("nombrePostes"),
            F.struct(
                F.concat(F.lit("Lieu "), supplier).alias("libelle"), F.lpad(supplier, 5, "0").alias("codePostal"), blank(even, supplier).alias("commune"),
                F.col("l_quantity").cast("double").alias("latitude"), F.when(even, F.col("l_quantity").cast("double")).alias("longitude"),
            ).alias("lieuTravail"),
            F.struct(blank(small, part).alias("nom"), part.alias("description"), even.alias("entrepriseAdaptee")).alias("entreprise"),
            F.col("l_returnflag").alias("codeNAF"), F.right(supplier, F.lit(2)).alias("secteurActivite"), F.col("l_linestatus").alias("secteurActiviteLibelle"),
            F.when(small, "0 salarié").alias("trancheEffectifEtab"),
            F.struct(
                F.when(even, F.concat(F.lit("Annuel de "), part)).alias("libelle"), blank(small, line).alias("commentaire"),
                F.when(F.col("l_returnflag") == "A", "Primes").alias("complement1"), F.lit("").alias("complement2"),
            ).alias("salaire"),
        )
    )


def stg_offers_full(spark, sf):
    rows = staging.stg_offers(full_offers(spark, sf))
    return rows.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("created_at", "updated_at")})


def stg_locations_full(spark, sf):
    return staging.stg_locations(full_offers(spark, sf))


def stg_employers_full(spark, sf):
    return staging.stg_employers(full_offers(spark, sf))


def stg_salaries_full(spark, sf):
    return staging.stg_salaries(full_offers(spark, sf))


def stg_location_slice(spark, sf):
    return staging.stg_locations(coded_offers(spark, sf), LOCATION)


def staged_communes(spark, sf):
    return plans_geo.staged_places(*place_lists(spark, sf))["communes"]


def staged_postal_codes(spark, sf):
    return plans_geo.staged_places(*place_lists(spark, sf))["postal_codes"]


def known_places(spark, sf):
    lists = plans_geo.staged_places(*place_lists(spark, sf))
    return settle(plans_geo.staged_place_names(lists), "places")


def stg_employer_slice(spark, sf):
    return staging.stg_employers(coded_offers(spark, sf), EMPLOYER)


def stg_salary_slice(spark, sf):
    return staging.stg_salaries(coded_offers(spark, sf), SALARY)


def offer_places(spark, sf):
    return marts.int_offer_places(staged(spark, sf), known_places(spark, sf))


def candidates(spark, sf):
    return matching.employer_candidates(employer_rows(spark, sf), "employer_name", ["postal_code", "naf_code"])


def employer_candidates(spark, sf):
    return candidates(spark, sf).drop("employer_candidate_id")


def matches(spark, sf):
    wanted = settle(candidates(spark, sf), "candidates")
    found = matching.match_employers(wanted, register_rows(spark, sf))
    return found.select(
        "employer_candidate_id", "normalized_employer_name", "postal_code", "naf_code", "offer_count",
        "siret", "siren", "legal_name", "match_method", "match_confidence", "match_status",
    )


def employer_match(spark, sf):
    return matches(spark, sf).drop("employer_candidate_id", "siren", "legal_name")


def register_search_results(spark, sf):
    """What a search by name and place finds in the register, per search, under an id of its own."""
    wanted = candidates(spark, sf).withColumn("commune_code", F.col("naf_code"))
    return emp.search_results(wanted, register_rows(spark, sf), "run-1")


def stg_register_matches(spark, sf):
    wanted = candidates(spark, sf).withColumn("commune_code", F.col("naf_code"))
    details = table(spark, sf, "supplier").select(
        F.lpad(text("s_suppkey"), 14, "0").alias("siret"),
        F.when(F.col("s_acctbal") > 0, text("s_nationkey")).alias("legal_category"),
        F.concat(F.lit("Chez "), "s_name").alias("trade_name"),
        F.concat(F.right(text("s_suppkey"), F.lit(2)), F.lit("Z")).alias("register_naf_code"),
        text(F.floor(F.col("s_acctbal") / 1000)).alias("employee_size_range"),
    )
    entries = register_rows(spark, sf).join(details, "siret")
    found = emp.raw_matches(settle(wanted, "candidates"), entries, "run-1")
    return emp.stg_register_matches(found).drop("employer_candidate_id", "legal_name")


def offer_employers(spark, sf):
    kept = settle(matches(spark, sf), "matches")
    linked = emp.int_offer_employers(employer_rows(spark, sf), kept, ["postal_code", "naf_code"])
    return linked.select("offer_id", "siret", "match_confidence", "match_status")


def pending_candidates(spark, sf):
    """Candidates left once the exact matches are kept."""
    kept = settle(matches(spark, sf), "matches").filter("match_method = 'exact'")
    return matching.pending_candidates(candidates(spark, sf), kept).drop("employer_candidate_id")


PLACE = ["commune_code", "naf_code"]


def enriched(spark, sf):
    """Offers with place and employer; the register stand-in lists a branch of each part's company where its suppliers
    are, but in every tenth place none."""
    s = staged(spark, sf).withColumn("postal_code", F.col("commune_code"))
    # The id is a hash of the columns that the matches are joined by.
    found = settle(matching.employer_candidates(s, "employer_name", ["postal_code", *PLACE]).drop("employer_candidate_id"), "candidates")
    branches = table(spark, sf, "lineitem").filter(F.col("l_suppkey") % 10 != 0).select("l_partkey", "l_suppkey").distinct()
    siren = F.lpad(text("l_partkey"), 9, "0")
    register = branches.select(
        F.concat(siren, F.lpad(text("l_suppkey"), 5, "0")).alias("siret"), siren.alias("siren"),
        F.concat(F.lit("SOCIETE "), text("l_partkey"), F.lit(" SA")).alias("legal_name"), text("l_suppkey").alias("postal_code"),
    )
    by_name = matching.match_employers(found, register)
    kept = settle(
        by_name.filter("match_status = 'matched'").select(
            "normalized_employer_name", "postal_code", *PLACE, "siren", "siret", "legal_name", "match_confidence", "match_status"
        ), "matches",
    )
    return marts.with_employers(marts.with_places(s, known_places(spark, sf)), kept, ["postal_code", *PLACE])


def offers_enriched(spark, sf):
    return enriched(spark, sf).select(
        "offer_id", "job_title", "contract_type", "commune_code", "commune_name", "departement_name", "region_name",
        "epci_name", "employer_name", "siret", "match_status", "salary_label", "salary_quality_flag",
    )


def mart_offers(spark, sf):
    return marts.mart_offers(
        enriched(spark, sf), ["offer_id", "job_title", "region_name", "siret", "contract_type", "salary_raw_text"]
    )


def mart_geo(spark, sf):
    offers = marts.with_places(staged(spark, sf), known_places(spark, sf))
    rows = marts.mart_places(
        offers, ["region_name", "departement_name", "commune_code"], "created_at", "employer_name",
        F.col("contract_type") == "CDI", F.col("job_title").contains("Alternance"), F.col("salary_label").isNotNull(),
        unit="year",
    )
    return rows.withColumn("period", F.date_format("period", "yyyy-MM-dd"))


def mart_employers(spark, sf):
    return marts.mart_employers(enriched(spark, sf), "siren", "employer_name", "departement_code", "activity_sector_label", "naf_code")


def salary_parse(spark, sf):
    return marts.offer_salaries(staged(spark, sf).select("offer_id", "salary_label"), "salary_label").withColumns(
        {c: F.round(c, 2) for c in ("salary_low", "salary_high", "salary_low_year", "salary_high_year")}
    )


def mart_salaries(spark, sf):
    offers = marts.with_places(staged(spark, sf), known_places(spark, sf))
    return marts.mart_salaries(offers, "salary_label", ["region_name", "contract_type"], "employer_name")


def mart_salaries_by_company(spark, sf):
    offers = marts.with_places(staged(spark, sf), known_places(spark, sf)).filter("employer_name is not null")
    # Means of one or two offers end in half a cent, which the two engines round differently.
    return marts.mart_salaries(offers, "salary_label", ["region_name", "contract_type", "employer_name"]).drop("mean_year")


def mart_trend(spark, sf):
    rows = marts.mart_trend(staged(spark, sf), "created_at", "updated_at", "employer_name")
    return rows.withColumn("period", F.date_format("period", "yyyy-MM-dd"))


def mart_trend_weekly(spark, sf):
    rows = marts.mart_trend(staged(spark, sf), "created_at", "updated_at", "employer_name", unit="week")
    return rows.withColumn("period", F.date_format("period", "yyyy-MM-dd"))


# Offers arrive in three parts, by the day they were created.
PARTS = ("1994-01-01", "1997-01-01")


def _parts(offers):
    day, (first, second) = F.col("created_at"), (F.lit(d).cast("timestamp") for d in PARTS)
    return {"a": offers.filter(day < first), "b": offers.filter((day >= first) & (day < second)), "c": offers.filter((day >= second) | day.isNull())}


def mart_geo_stored(spark, sf):
    """The answer by place from counts that were stored part by part."""
    levels, kept = ["region_name", "departement_name", "commune_code"], marts.StoredStates(spark, scratch_path(spark, "place-states"))
    for name, part in _parts(marts.with_places(staged(spark, sf), known_places(spark, sf))).items():
        kept.add(
            marts.place_states(
                part, levels, "created_at", "employer_name", F.col("contract_type") == "CDI",
                F.col("job_title").contains("Alternance"), F.col("salary_label").isNotNull(), unit="year",
            ), name,
        )
    rows = marts.places_from_states(kept.all(), levels, "employer_name")
    return rows.withColumn("period", F.date_format("period", "yyyy-MM-dd"))


def mart_trend_stored(spark, sf):
    """The trend from counts that were stored part by part; an offer is updated in a later part than it was created in."""
    kept = marts.StoredStates(spark, scratch_path(spark, "trend-states"))
    for name, part in _parts(staged(spark, sf)).items():
        kept.add(marts.trend_states(part, "created_at", "updated_at", "employer_name"), name)
    rows = marts.trend_from_states(kept.all())
    return rows.withColumn("period", F.date_format("period", "yyyy-MM-dd"))


def load_failing(spark, sf):
    """Line items loaded with their checks: the rows that broke a rule, and which."""
    return _line_load(spark, sf).failing.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join("broken", ",").alias("broken"))


def load_counts(spark, sf):
    """The numbers of the same load, observed while it was written."""
    return _line_load(spark, sf).report()


def _lines(spark, sf):
    discount = F.when(F.col("l_discount") < 0.09, F.col("l_discount"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity", discount.alias("l_discount"))


def _line_load(spark, sf):
    return checked.load_checked(
        _lines(spark, sf), scratch_path(spark, "load"), not_null=["l_discount", "l_orderkey"],
        accepted={"l_returnflag": ["A", "N"]}, rules={"large": F.col("l_quantity") > 45},
    )


def accepted_values(spark, sf):
    return quality.check_accepted_values(table(spark, sf, "lineitem"), "l_returnflag", ["A", "N"])


def check_not_null(spark, sf):
    d = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return quality.check_not_null(d, "quality")


def check_unique(spark, sf):
    return quality.check_unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def check_required(spark, sf):
    d = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return quality.check_required_columns(d, "doc_id bigint not null, quality int not null, toxic int").select(
        "doc_id", "missing_column"
    )


def value_counts(spark, sf):
    return reports.value_counts(table(spark, sf, "orders"), "o_orderpriority")


def daily_counts(spark, sf):
    rows = reports.daily_counts(table(spark, sf, "events"), "ts", ["event_type"])
    return rows.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def completion_report(spark, sf):
    # Only whether a text is there counts, so only that goes into the join.
    d = table(spark, sf, "documents").withColumn("text", F.when(F.col("text").isNotNull(), 1))
    return reports.completion_report(d.join(table(spark, sf, "labels"), "doc_id", "left"))


def row_counts(spark, sf):
    return reports.row_counts(**{n: table(spark, sf, n) for n in ("orders", "lineitem", "events", "documents", "pages")})


def sample_non_null(spark, sf):
    d = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return reports.sample_non_null(d.select("doc_id", "quality"), "quality", ["doc_id"])


QUERIES = {
    "stg_offers": stg_offer_slice,
    "stg_locations": stg_location_slice,
    "stg_offers_full": stg_offers_full,
    "stg_locations_full": stg_locations_full,
    "stg_employers_full": stg_employers_full,
    "stg_salaries_full": stg_salaries_full,
    "staged_communes": staged_communes,
    "staged_postal_codes": staged_postal_codes,
    "register_search_results": register_search_results,
    "stg_register_matches": stg_register_matches,
    "stg_employers": stg_employer_slice,
    "stg_salaries": stg_salary_slice,
    "offer_places": offer_places,
    "employer_candidates": employer_candidates,
    "employer_match": employer_match,
    "offer_employers": offer_employers,
    "pending_candidates": pending_candidates,
    "offers_enriched": offers_enriched,
    "mart_offers": mart_offers,
    "mart_geo": mart_geo,
    "mart_employers": mart_employers,
    "salary_parse": salary_parse,
    "mart_salaries": mart_salaries,
    "mart_salaries_by_company": mart_salaries_by_company,
    "mart_trend": mart_trend,
    "mart_trend_weekly": mart_trend_weekly,
    "mart_geo_stored": mart_geo_stored,
    "mart_trend_stored": mart_trend_stored,
    "load_failing": load_failing,
    "load_counts": load_counts,
    "accepted_values": accepted_values,
    "check_not_null": check_not_null,
    "check_unique": check_unique,
    "check_required_columns": check_required,
    "value_counts": value_counts,
    "daily_counts": daily_counts,
    "completion_report": completion_report,
    "row_counts": row_counts,
    "sample_non_null": sample_non_null,
}

NAMED = """placed AS (SELECT o.*, c.nom AS commune_name, CAST(n.n_nationkey AS VARCHAR) AS departement_code, n.n_name AS departement_name,
    r.r_name AS region_name, CASE WHEN e.r_regionkey IS NOT NULL THEN 'EPCI ' || e.r_name END AS epci_name,
    c.code AS c_code, c.dep, c.reg, c.epci
  FROM offers o LEFT JOIN communes c ON c.code = o.commune LEFT JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = c.dep
  LEFT JOIN region r ON CAST(r.r_regionkey AS VARCHAR) = c.reg LEFT JOIN region e ON 'E' || CAST(e.r_regionkey AS VARCHAR) = c.epci)"""
PLACED = f"WITH {COMMUNES_SQL}, {CODED_SQL}, {NAMED}"
MAPPED = f"""{PLACED}, listed AS (SELECT DISTINCT lpad(CAST(l_partkey AS VARCHAR), 9, '0') || lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS siret,
    'SOCIETE ' || l_partkey AS name, CAST(l_suppkey AS VARCHAR) AS place FROM lineitem WHERE l_suppkey % 10 <> 0),
  asked AS (SELECT DISTINCT replace(employer_name, 'Société', 'SOCIETE') AS name, commune FROM offers WHERE employer_name IS NOT NULL),
  near AS (SELECT a.name, a.commune, l.siret,
      row_number() OVER (PARTITION BY a.name, a.commune ORDER BY levenshtein(a.name, l.name), l.siret) AS rn
    FROM asked a JOIN listed l ON l.place = a.commune
      AND levenshtein(a.name, l.name) <= greatest(1, greatest(length(a.name), length(l.name)) * 15 // 100)),
  full_rows AS (SELECT p.*, s.siret FROM placed p LEFT JOIN near s
    ON s.rn = 1 AND s.name = replace(p.employer_name, 'Société', 'SOCIETE') AND s.commune = p.commune)"""
FLAG = "CASE WHEN salary_label IS NULL THEN 'none' ELSE 'label' END"
FIGURES = """CAST(count(p.salary_label) AS BIGINT) AS n_labels, CAST(count(low_year) AS BIGINT) AS n_read, round(min(low_year), 2) AS lowest_year,
  round(max(high_year), 2) AS highest_year, round(avg((low_year + high_year) / 2), 2) AS mean_year"""
LEVEL = """SELECT '{level}' AS level, {zones}, strftime(date_trunc('year', created), '%Y-%m-%d') AS period,
  CAST(count(*) AS BIGINT) AS n_offers, CAST(count(DISTINCT employer_name) AS BIGINT) AS n_companies,
  round(count(*) FILTER (contract_type = 'CDI') / count(*), 4) AS permanent_share,
  round(count(*) FILTER (job_title = 'Alternance data') / count(*), 4) AS apprentice_share,
  round(count(salary_label) / count(*), 4) AS salary_share FROM placed GROUP BY {group}, period"""
TREND = """WITH {offers}, m AS (SELECT date_trunc('{unit}', created) AS p, 1 AS new, employer_name AS e FROM offers
    UNION ALL SELECT date_trunc('{unit}', updated), 0, employer_name FROM offers)
  SELECT strftime(p, '%Y-%m-%d') AS period, CAST(sum(new) AS BIGINT) AS n_published, CAST(sum(1 - new) AS BIGINT) AS n_updated,
    CAST(count(DISTINCT e) FILTER (new = 1) AS BIGINT) AS n_companies FROM m GROUP BY p"""

ORACLE = {
    "stg_offers": f"""WITH {CODED_SQL} SELECT offer_id, job_title, strftime(created, '%Y-%m-%d') AS created_at,
      strftime(updated, '%Y-%m-%d') AS updated_at, contract_type FROM offers""",
    "stg_locations": f"WITH {CODED_SQL} SELECT offer_id, commune AS commune_code FROM offers",
    "staged_communes": f"""WITH {COMMUNES_SQL} SELECT code AS commune_code, nom AS commune_name, dep AS departement_code, reg AS region_code,
      CASE WHEN len(codes) = 0 THEN '[]' WHEN codes IS NOT NULL THEN '["' || codes[1] || '","' || codes[2] || '"]' END AS postal_codes_json,
      population, epci AS epci_code FROM communes""",
    "staged_postal_codes": f"WITH {COMMUNES_SQL} SELECT code AS commune_code, unnest(codes) AS code_postal FROM communes",
    "register_search_results": f"""WITH {EMPLOYERS_SQL}, n AS (SELECT 'COMPAGNIE N ' || right(s_name, 3) AS name,
        CAST(s_nationkey AS VARCHAR) AS postal_code, count(*) AS n, lpad(CAST(min(s_suppkey) AS VARCHAR), 14, '0') AS siret
        FROM supplier GROUP BY 1, 2), r AS (SELECT DISTINCT c.name AS search_term, c.postal_code, c.naf_code AS commune_code, CAST(coalesce(n.n, 0) AS BIGINT) AS n_found,
        json_object('term', c.name, 'postal_code', c.postal_code, 'commune_code', c.naf_code)::VARCHAR AS request_payload,
        json_object('total', coalesce(n.n, 0), 'first_siret', n.siret)::VARCHAR AS response_payload
        FROM candidates c LEFT JOIN n ON n.name = c.name AND n.postal_code = c.postal_code)
      SELECT *, 'run-1' AS run_id, sha256('run-1|' || request_payload) AS search_id FROM r""",
    "stg_register_matches": f"""WITH {EMPLOYERS_SQL} SELECT right(siret, 9) AS siren, siret, 'Chez ' || s_name AS trade_name,
      CASE WHEN s_acctbal > 0 THEN CAST(s_nationkey AS VARCHAR) END AS legal_category,
      right(CAST(s_suppkey AS VARCHAR), 2) || 'Z' AS naf_code, postal_code, naf_code AS commune_code,
      CAST(CAST(floor(s_acctbal / 1000) AS BIGINT) AS VARCHAR) AS employee_size_range, match_method,
      CAST(match_confidence AS DOUBLE) AS match_confidence, match_status
      FROM matches LEFT JOIN supplier ON lpad(CAST(s_suppkey AS VARCHAR), 14, '0') = siret""",
    "stg_employers": f"WITH {CODED_SQL} SELECT offer_id, employer_name, naf_code, industry_label AS activity_sector_label FROM offers",
    "stg_salaries": f"""WITH {CODED_SQL} SELECT offer_id, salary_label, CAST(NULL AS VARCHAR) AS salary_comment,
      salary_label AS salary_raw_text, {FLAG} AS salary_quality_flag FROM offers""",
    "offer_places": f"""{PLACED} SELECT offer_id, commune AS commune_code, commune_name, departement_code, departement_name,
      CASE WHEN region_name IS NOT NULL THEN reg END AS region_code, region_name,
      CASE WHEN epci_name IS NOT NULL THEN epci END AS epci_code, epci_name FROM placed""",
    "employer_candidates": f"WITH {EMPLOYERS_SQL} SELECT name AS normalized_employer_name, postal_code, naf_code, offer_count FROM candidates",
    "employer_match": f"""WITH {EMPLOYERS_SQL} SELECT name AS normalized_employer_name, postal_code, naf_code, offer_count, siret,
      match_method, CAST(match_confidence AS DOUBLE) AS match_confidence, match_status FROM matches""",
    "offer_employers": f"""WITH {EMPLOYERS_SQL} SELECT e.offer_id, m.siret, CAST(m.match_confidence AS DOUBLE) AS match_confidence,
      coalesce(m.match_status, 'unmatched') AS match_status FROM employers e
      LEFT JOIN matches m ON m.name = e.name AND m.postal_code = e.postal_code AND m.naf_code = e.naf_code""",
    "pending_candidates": f"""WITH {EMPLOYERS_SQL} SELECT name AS normalized_employer_name, postal_code, naf_code, offer_count
      FROM matches WHERE match_method IS DISTINCT FROM 'exact'""",
    "offers_enriched": f"""{MAPPED} SELECT offer_id, job_title, contract_type, commune AS commune_code, commune_name, departement_name,
      region_name, epci_name, employer_name, siret, CASE WHEN siret IS NULL THEN 'unmatched' ELSE 'matched' END AS match_status,
      salary_label, {FLAG} AS salary_quality_flag FROM full_rows""",
    "mart_offers": f"{MAPPED} SELECT offer_id, job_title, region_name, siret, contract_type, salary_label AS salary_raw_text FROM full_rows",
    "mart_geo": PLACED + " " + " UNION ALL ".join([
        LEVEL.format(level="region_name", zones="region_name, CAST(NULL AS VARCHAR) AS departement_name, CAST(NULL AS VARCHAR) AS commune_code", group="region_name"),
        LEVEL.format(level="departement_name", zones="region_name, departement_name, CAST(NULL AS VARCHAR) AS commune_code", group="region_name, departement_name"),
        LEVEL.format(level="commune_code", zones="region_name, departement_name, commune AS commune_code", group="region_name, departement_name, commune"),
    ]),
    "mart_employers": f"""{MAPPED}, z AS (SELECT coalesce(left(siret, 9), employer_name) AS employer_key, departement_code AS zone,
        count(*) AS n, max(industry_label) AS sector, max(naf_code) AS size FROM full_rows
        WHERE coalesce(siret, employer_name) IS NOT NULL GROUP BY 1, 2)
      SELECT employer_key, CAST(sum(n) AS BIGINT) AS n_offers, CAST(count(zone) AS BIGINT) AS n_zones,
        coalesce(string_agg(zone, ',' ORDER BY zone), '') AS zones, max(sector) AS sector, max(size) AS size FROM z GROUP BY 1""",
    "salary_parse": f"""WITH {CODED_SQL} SELECT offer_id, salary_label,
      CASE WHEN salary_label LIKE 'Annuel%' THEN 'Annuel' WHEN salary_label LIKE 'Mensuel%' THEN 'Mensuel' END AS salary_period,
      round(CASE WHEN salary_label LIKE 'Mensuel%' THEN low_year / 13 ELSE low_year END, 2) AS salary_low,
      round(CASE WHEN salary_label LIKE 'Mensuel%' THEN high_year / 13 ELSE high_year END, 2) AS salary_high,
      round(low_year, 2) AS salary_low_year, round(high_year, 2) AS salary_high_year FROM offers""",
    "mart_salaries": f"""{PLACED}, t AS (SELECT region_name, contract_type, salary_label, row_number() OVER (PARTITION BY region_name,
        contract_type ORDER BY count(*) DESC, salary_label) AS rn FROM placed WHERE salary_label IS NOT NULL GROUP BY 1, 2, 3)
      SELECT p.region_name, p.contract_type, CAST(count(*) AS BIGINT) AS n_offers,
      CAST(count(DISTINCT employer_name) AS BIGINT) AS n_companies, {FIGURES}, any_value(t.salary_label) AS salary_text FROM placed p
      LEFT JOIN t ON rn = 1 AND t.region_name IS NOT DISTINCT FROM p.region_name AND t.contract_type = p.contract_type GROUP BY 1, 2""",
    "mart_salaries_by_company": f"""{PLACED}, named AS (SELECT * FROM placed WHERE employer_name IS NOT NULL),
      t AS (SELECT region_name, contract_type, employer_name, salary_label, row_number() OVER (PARTITION BY region_name, contract_type,
        employer_name ORDER BY count(*) DESC, salary_label) AS rn FROM named WHERE salary_label IS NOT NULL GROUP BY 1, 2, 3, 4)
      SELECT p.region_name, p.contract_type, p.employer_name, CAST(count(*) AS BIGINT) AS n_offers, {FIGURES.split(", round(avg")[0]},
      any_value(t.salary_label) AS salary_text FROM named p LEFT JOIN t ON rn = 1 AND t.region_name IS NOT DISTINCT FROM p.region_name
      AND t.contract_type = p.contract_type AND t.employer_name = p.employer_name GROUP BY 1, 2, 3""",
    "mart_trend": TREND.format(offers=CODED_SQL, unit="day"),
    "mart_trend_weekly": TREND.format(offers=CODED_SQL, unit="week"),
    "accepted_values": """SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem
      WHERE l_returnflag NOT IN ('A', 'N') GROUP BY 1""",
    "check_not_null": """SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
      WHERE l.quality IS NULL""",
    "check_unique": """SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem
      GROUP BY 1, 2 HAVING count(*) > 1""",
    "check_required_columns": """SELECT d.doc_id, 'quality' AS missing_column FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
      WHERE l.quality IS NULL""",
    "value_counts": "SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n_rows FROM orders GROUP BY 1",
    "daily_counts": """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, CAST(count(*) AS BIGINT) AS n_rows FROM events GROUP BY 1, 2""",
    "completion_report": "WITH d AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS non_null_count, CAST(count(*) - count({c}) AS BIGINT) AS null_count,
      round(count({c}) * 100.0 / count(*), 2) AS completion_rate FROM d"""
        for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
    ),
    "row_counts": " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", CAST(count(*) AS BIGINT) AS n_rows FROM {t}"""
        for t in ("orders", "lineitem", "events", "documents", "pages")
    ),
    "sample_non_null": "SELECT doc_id, quality FROM labels ORDER BY doc_id LIMIT 5",
}
ORACLE |= {
    "mart_geo_stored": ORACLE["mart_geo"],
    "mart_trend_stored": ORACLE["mart_trend"],
    "load_failing": """SELECT l_orderkey, l_linenumber, l_partkey, concat_ws(',', CASE WHEN l_discount >= 0.09 THEN 'not_null:l_discount' END,
        CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'accepted:l_returnflag' END, CASE WHEN l_quantity > 45 THEN 'large' END) AS broken
      FROM lineitem WHERE l_discount >= 0.09 OR l_returnflag NOT IN ('A', 'N') OR l_quantity > 45""",
    "load_counts": """SELECT 'rows' AS "check", count(*) AS n_rows FROM lineitem
      UNION ALL SELECT 'failing', count(*) FROM lineitem WHERE l_discount >= 0.09 OR l_returnflag NOT IN ('A', 'N') OR l_quantity > 45
      UNION ALL SELECT 'not_null:l_discount', count(*) FROM lineitem WHERE l_discount >= 0.09
      UNION ALL SELECT 'not_null:l_orderkey', 0 UNION ALL SELECT 'accepted:l_returnflag', count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')
      UNION ALL SELECT 'large', count(*) FROM lineitem WHERE l_quantity > 45""",
}
FULL = """f AS (SELECT *, CAST(l_partkey AS VARCHAR) AS part, CAST(l_suppkey AS VARCHAR) AS sup, CAST(l_linenumber AS VARCHAR) AS line,
    l_suppkey % 2 = 0 AS even, l_quantity < 10 AS small FROM lineitem),
  k AS (SELECT *, concat_ws('-', l_orderkey, line, part, sup, strftime(l_shipdate, '%Y%m%d'), CAST(l_tax AS VARCHAR)) AS offer_id FROM f)"""
ORACLE |= {
    "stg_offers_full": f"""WITH {FULL} SELECT offer_id, 'Poste ' || part AS job_title, CASE WHEN NOT small THEN part END AS job_description,
      'M' || sup AS rome_code, CASE WHEN NOT even THEN sup END AS rome_label, l_returnflag AS appellation_label,
      strftime(l_shipdate, '%Y-%m-%d') AS created_at, strftime(CAST(l_shipdate AS DATE) + 3, '%Y-%m-%d') AS updated_at,
      l_linestatus AS contract_type, CASE WHEN even THEN l_linestatus END AS contract_type_label, 'E1' AS contract_nature,
      line AS qualification_code, CASE WHEN NOT small THEN line END AS qualification_label, 'D' AS experience_required_code,
      line || ' an(s)' AS experience_required_label, l_returnflag = 'A' AS is_alternance, CAST(l_linenumber AS INT) AS post_count FROM k""",
    "stg_locations_full": f"""WITH {FULL} SELECT offer_id, 'Lieu ' || sup AS workplace_label, lpad(sup, 5, '0') AS postal_code,
      CASE WHEN NOT even THEN sup END AS commune_code, CAST(l_quantity AS DOUBLE) AS latitude,
      CASE WHEN even THEN CAST(l_quantity AS DOUBLE) END AS longitude FROM k""",
    "stg_employers_full": f"""WITH {FULL} SELECT offer_id, CASE WHEN NOT small THEN part END AS employer_name, part AS employer_description,
      l_returnflag AS naf_code, right(sup, 2) AS activity_sector_code, l_linestatus AS activity_sector_label,
      CASE WHEN small THEN '0 salarié' END AS employee_size_range, even AS is_adapted_company FROM k""",
    "stg_salaries_full": f"""WITH {FULL}, x AS (SELECT offer_id, CASE WHEN even THEN 'Annuel de ' || part END AS salary_label,
        CASE WHEN NOT small THEN line END AS salary_comment, CASE WHEN l_returnflag = 'A' THEN 'Primes' END AS salary_extra_1,
        CAST(NULL AS VARCHAR) AS salary_extra_2 FROM k)
      SELECT *, nullif(concat_ws(' | ', salary_label, salary_comment, salary_extra_1, salary_extra_2), '') AS salary_raw_text,
        CASE WHEN salary_label IS NOT NULL THEN 'label' WHEN coalesce(salary_comment, salary_extra_1) IS NOT NULL THEN 'text' ELSE 'none' END
          AS salary_quality_flag FROM x""",
}
