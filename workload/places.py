"""Lookups by code and by name, and the place and offer models built from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobscape.operators import geo
from jobscape.operators.reports import append_batches
from jobscape.plans import geo as plans_geo, offers as plans_offers
from jobscape.plans.daily import missing_department
from jobscape.functions import text as tx
from jobscape.sinks.tables import settle
from workload.tables import (
    CODED_SQL,
    COMMUNES_SQL,
    NAMED_SQL,
    PLACES_SQL,
    coded_offers,
    named_offers,
    place_lists,
    table,
    text,
)


def places(spark, sf):
    return plans_geo.communes_by_postal_code(*place_lists(spark, sf))


def known_places(spark, sf):
    """The place table as the offer models find it: written before they run."""
    return settle(places(spark, sf), "places")


def star_lookup(spark, sf):
    nations = geo.code_name(table(spark, sf, "nation"), "n_nationkey", "n_name", "nk", "nation").join(
        table(spark, sf, "nation").select(F.col("n_nationkey").alias("nk"), "n_regionkey"), "nk"
    )
    regions = geo.code_name(table(spark, sf, "region"), "r_regionkey", "r_name", "rk", "region")
    parts = table(spark, sf, "part").select("p_partkey", "p_size")
    joined = geo.lookup_left(parts, [(nations, "p_size", "nk"), (regions, "n_regionkey", "rk")])
    return joined.select("p_partkey", "p_size", "nation", "region")


def explode_codes(spark, sf):
    codes = F.when(F.col("p_size") > 40, F.array().cast("array<string>")).when(
        F.col("p_size") > 5, F.split("p_name", " ")
    )
    parts = table(spark, sf, "part").select("p_partkey", "p_type", codes.alias("codes"))
    return geo.explode_codes(parts, "codes", "code")


def distinct_rows(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.array("l_returnflag", "l_linestatus").alias("marks")
    )
    return geo.distinct_rows(lines).withColumn("marks", F.array_join("marks", "-"))


def name_index(spark, sf):
    c = table(spark, sf, "customer").select(
        F.lower("c_mktsegment").alias("city"), text("c_nationkey").alias("dept"), "c_name", "c_acctbal"
    )
    return geo.name_index(c, {"city_upper": "city", "dept_upper": "dept"}, ["c_name", "c_acctbal"])


def wildcard_join(spark, sf):
    """Customers against a name index of themselves; those in debt name no department."""
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_name", F.concat(F.lit("n"), text("c_nationkey")).alias("dept"), "c_acctbal")
    index = geo.name_index(c, {"city_upper": "c_mktsegment", "dept_upper": "dept"}, ["c_name"])
    facts = c.select(
        "c_custkey", F.lower("c_mktsegment").alias("city"), F.when(F.col("c_acctbal") >= 0, F.col("dept")).alias("department")
    )
    joined = geo.join_by_name(facts, index, "city", "department", "city_upper", "dept_upper")
    return joined.select("c_custkey", "city_upper", "dept_upper", "c_name")


def offers_geo(spark, sf):
    """The common offer model of the first source, with its repeated rows."""
    return offer_columns(plans_offers.coded_offers(coded_offers(spark, sf), known_places(spark, sf)))


def offers_geo_once(spark, sf):
    return offer_columns(
        plans_offers.coded_offers(coded_offers(spark, sf).distinct(), known_places(spark, sf), one_row_per_offer=True)
    )


def offer_columns(df):
    return df.select(
        "offer_id", "job_title", F.date_format("created_at", "yyyy-MM-dd").alias("created"), "contract_type",
        "code_postal", "nom_commune", "numero_departement", "nom_departement", "nom_region", "nom_epci",
        "employer_name", "naf_code", "salary_label", "has_salary_info", "is_alternance",
    )


def named_model(spark, sf):
    return plans_offers.named_offers(named_offers(spark, sf), known_places(spark, sf)).select(
        "offer_id", "job_title", "code_postal", "nom_commune", "numero_departement", "nom_departement",
        "nom_region", "nom_epci", "has_salary_info", "is_alternance",
    )


def offers_projection(spark, sf):
    o = coded_offers(spark, sf)
    return o.select(
        tx.to_id_string("id").alias("offer_id"),
        F.col("intitule").alias("job_title"),
        F.col("typeContrat").alias("contract_type"),
        F.col("experienceExige").alias("experience_required"),
        tx.null_if_blank("entreprise.nom").alias("employer_name"),
        tx.null_if_blank("lieuTravail.commune").alias("commune_code"),
        tx.null_if_blank("salaire.libelle").alias("salary_label"),
        F.lit(None).cast("string").alias("salary_comment"),
    )


def offers_geo_left(spark, sf):
    """The older view: offers that name a commune, matched or not."""
    o = coded_offers(spark, sf)
    missing = F.lit(None).cast("string")
    wide = o.withColumns(
        {
            **{c: missing for c in (
                "romeCode", "romeLibelle", "appellationlibelle", "typeContratLibelle", "natureContrat",
                "secteurActivite", "dureeTravailLibelle", "dureeTravailLibelleConverti", "qualificationCode",
                "qualificationLibelle",
            )},
            "nombrePostes": F.lit(1),
            "alternance": F.lit(False),
            "accessibleTH": F.lit(False),
            "origineOffre": F.struct(missing.alias("origine"), missing.alias("urlOrigine")),
            # The view joins on the code as it stands, so it is trimmed beforehand.
            "lieuTravail": F.struct(
                F.col("lieuTravail.libelle").alias("libelle"),
                F.col("lieuTravail.codePostal").alias("codePostal"),
                F.trim("lieuTravail.commune").alias("commune"),
            ),
        }
    )
    names = settle(plans_geo.commune_names(*place_lists(spark, sf)), "names")
    return plans_offers.offer_view(wide, names).select(
        "offre_id", "intitule", "commune_code", "entreprise_nom", "departement_nom", "region_nom", "epci_nom"
    )


def commune_first_code(spark, sf):
    return plans_geo.communes_first_code(*place_lists(spark, sf))


def check_missing_dept(spark, sf):
    """Offers whose commune has no known department; here the ones of two regions lack it."""
    communes, departments, regions, epcis = place_lists(spark, sf)
    some = departments.filter(F.col("codeRegion") != "0")
    known = settle(plans_geo.communes_by_postal_code(communes, some, regions, epcis), "places")
    return missing_department(plans_offers.coded_offers(coded_offers(spark, sf), known))


def append_both(spark, sf):
    """Suppliers and customers as one list; each lacks columns of the other."""
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("s_key"))
    c = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return append_batches(s, c)


def entry_regions(spark, sf):
    """Offers, salaries named and apprenticeships per region."""
    offers = plans_offers.coded_offers(coded_offers(spark, sf), known_places(spark, sf))
    return offers.groupBy("nom_region").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("has_salary_info").alias("n_salary"),
        F.sum("is_alternance").alias("n_apprentice"),
    )


QUERIES = {
    "communes_by_postal_code": places,
    "commune_first_code": commune_first_code,
    "star_lookup": star_lookup,
    "explode_codes": explode_codes,
    "distinct_rows": distinct_rows,
    "name_index": name_index,
    "wildcard_join": wildcard_join,
    "offers_projection": offers_projection,
    "offers_geo": offers_geo,
    "offers_geo_once": offers_geo_once,
    "offers_by_name": named_model,
    "offers_geo_left": offers_geo_left,
    "check_missing_dept": check_missing_dept,
    "append_batches": append_both,
    "offers_per_region": entry_regions,
}

OFFER_COLUMNS = """o.offer_id, o.job_title, strftime(o.created, '%Y-%m-%d') AS created, o.contract_type,
  g.code_postal, g.commune_nom AS nom_commune, g.departement_code AS numero_departement, g.departement_nom AS nom_departement,
  g.region_nom AS nom_region, g.epci_nom AS nom_epci, o.employer_name, o.naf_code, o.salary_label,
  CASE WHEN o.salary_label IS NULL THEN 0 ELSE 1 END AS has_salary_info,
  CASE WHEN o.job_title LIKE 'Alternance%' THEN 1 ELSE 0 END AS is_alternance"""

ORACLE = {
    "communes_by_postal_code": f"WITH {PLACES_SQL} SELECT * FROM places",
    "commune_first_code": f"""WITH {COMMUNES_SQL} SELECT c.nom AS commune_nom, c.codes[1] AS code_postal,
      CAST(n.n_nationkey AS VARCHAR) AS departement_code, n.n_name AS departement_nom, r.r_name AS region_nom,
      'EPCI ' || e.r_name AS epci_nom, c.population FROM communes c
      LEFT JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = c.dep LEFT JOIN region r ON CAST(r.r_regionkey AS VARCHAR) = c.reg
      LEFT JOIN region e ON 'E' || CAST(e.r_regionkey AS VARCHAR) = c.epci""",
    "star_lookup": """SELECT p_partkey, p_size, n_name AS nation, r_name AS region FROM part
      LEFT JOIN nation ON n_nationkey = p_size LEFT JOIN region ON r_regionkey = n_regionkey""",
    "explode_codes": """SELECT p_partkey, p_type, unnest(string_split(p_name, ' ')) AS code FROM part
      WHERE p_size > 5 AND p_size <= 40""",
    "distinct_rows": "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag || '-' || l_linestatus AS marks FROM lineitem",
    "name_index": """SELECT upper(c_mktsegment) AS city_upper, CAST(c_nationkey AS VARCHAR) AS dept_upper,
      max(c_name) AS c_name, max(c_acctbal) AS c_acctbal FROM customer GROUP BY 1, 2""",
    "wildcard_join": """WITH i AS (SELECT c_mktsegment AS seg, c_nationkey AS nk, max(c_name) AS c_name FROM customer GROUP BY 1, 2)
      SELECT c.c_custkey, i.seg AS city_upper, 'N' || CAST(i.nk AS VARCHAR) AS dept_upper, i.c_name FROM customer c
      JOIN i ON i.seg = c.c_mktsegment AND (c.c_acctbal < 0 OR i.nk = c.c_nationkey)""",
    "offers_projection": f"""WITH {CODED_SQL} SELECT offer_id, job_title, contract_type, experience_required, employer_name,
      commune AS commune_code, salary_label, CAST(NULL AS VARCHAR) AS salary_comment FROM offers""",
    "offers_geo": f"""WITH {PLACES_SQL}, {CODED_SQL} SELECT {OFFER_COLUMNS} FROM offers o
      JOIN places g ON g.commune_code = o.commune""",
    "offers_geo_once": f"""WITH {PLACES_SQL}, {CODED_SQL}, rows AS (SELECT {OFFER_COLUMNS}, row_number() OVER
        (PARTITION BY o.offer_id ORDER BY g.code_postal) AS rn FROM (SELECT DISTINCT * FROM offers) o
        JOIN places g ON g.commune_code = o.commune)
      SELECT * EXCLUDE rn FROM rows WHERE rn = 1""",
    "offers_by_name": f"""WITH {PLACES_SQL}, {NAMED_SQL} SELECT o.offer_id, o.job_title, g.code_postal, g.commune_nom AS nom_commune,
      g.departement_code AS numero_departement, g.departement_nom AS nom_departement, g.region_nom AS nom_region,
      g.epci_nom AS nom_epci, o.has_salary_info, 0 AS is_alternance
      FROM (SELECT DISTINCT * FROM named) o JOIN name_index g
      ON upper(o.city) = g.nom_upper AND (upper(o.dept) = g.dep_upper OR o.dept IS NULL)""",
    "offers_geo_left": f"""WITH {COMMUNES_SQL}, {CODED_SQL} SELECT o.offer_id AS offre_id, o.job_title AS intitule,
      o.commune AS commune_code, coalesce(o.employer_name, '') AS entreprise_nom, n.n_name AS departement_nom,
      r.r_name AS region_nom, 'EPCI ' || e.r_name AS epci_nom FROM offers o LEFT JOIN communes c ON c.code = o.commune
      LEFT JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = c.dep LEFT JOIN region r ON CAST(r.r_regionkey AS VARCHAR) = c.reg
      LEFT JOIN region e ON 'E' || CAST(e.r_regionkey AS VARCHAR) = c.epci WHERE o.commune IS NOT NULL""",
    "check_missing_dept": f"""WITH {PLACES_SQL}, {CODED_SQL} SELECT o.offer_id, g.code_postal, CAST(NULL AS VARCHAR) AS nom_departement
      FROM offers o JOIN places g ON g.commune_code = o.commune
      JOIN nation n ON n.n_name = g.departement_nom AND n.n_regionkey = 0""",
    "append_batches": """SELECT s_name AS name, s_suppkey AS s_key, NULL AS segment FROM supplier
      UNION ALL SELECT c_name, NULL, c_mktsegment FROM customer""",
    "offers_per_region": f"""WITH {PLACES_SQL}, {CODED_SQL} SELECT g.region_nom AS nom_region, CAST(count(*) AS BIGINT) AS n_rows,
      CAST(count(o.salary_label) AS BIGINT) AS n_salary,
      CAST(count(*) FILTER (o.job_title LIKE 'Alternance%') AS BIGINT) AS n_apprentice
      FROM offers o JOIN places g ON g.commune_code = o.commune GROUP BY 1""",
}
