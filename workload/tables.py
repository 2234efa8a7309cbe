"""The given tables, and job-market tables derived from them.

The derived tables stand in for the domain: suppliers as communes, nations and regions as
departments and regions, line items and orders as offers, customers as employers. Next to
each stands the same derivation as DuckDB text, for the check queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def money(c: str) -> F.Column:
    """Two-decimal text of an amount; the same digits in every engine."""
    return F.col(c).cast("decimal(18,2)").cast("string")


# --- places -----------------------------------------------------------------------


def communes(spark, sf_dir):
    nation = F.col("s_nationkey")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("Ville "), F.right("s_name", F.lit(1))).alias("nom"),
        text("s_suppkey").alias("code"),
        text(nation).alias("codeDepartement"),
        F.concat(F.lit("E"), text(nation % 7)).alias("codeEpci"),
        text(F.floor(nation / 5)).alias("codeRegion"),
        F.when(F.col("s_acctbal") < 0, F.array().cast("array<string>"))
        .when(F.col("s_acctbal") <= 8000, F.array(F.right("s_name", F.lit(5)), F.concat(F.lit("P"), text(nation))))
        .alias("codesPostaux"),
        F.floor("s_acctbal").alias("population"),
    )


def departments(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("nom"), text("n_nationkey").alias("code"), text("n_regionkey").alias("codeRegion")
    )


def regions(spark, sf_dir):
    return table(spark, sf_dir, "region").select(F.col("r_name").alias("nom"), text("r_regionkey").alias("code"))


def epcis(spark, sf_dir):
    return table(spark, sf_dir, "region").select(
        F.concat(F.lit("EPCI "), "r_name").alias("nom"), F.concat(F.lit("E"), text("r_regionkey")).alias("code")
    )


def place_lists(spark, sf_dir):
    return [f(spark, sf_dir) for f in (communes, departments, regions, epcis)]


COMMUNES_SQL = """communes AS (
  SELECT 'Ville ' || right(s_name, 1) AS nom, CAST(s_suppkey AS VARCHAR) AS code,
    CAST(s_nationkey AS VARCHAR) AS dep, 'E' || CAST(s_nationkey % 7 AS VARCHAR) AS epci,
    CAST(s_nationkey // 5 AS VARCHAR) AS reg,
    CASE WHEN s_acctbal < 0 THEN CAST([] AS VARCHAR[])
         WHEN s_acctbal <= 8000 THEN [right(s_name, 5), 'P' || CAST(s_nationkey AS VARCHAR)] END AS codes,
    CAST(floor(s_acctbal) AS BIGINT) AS population
  FROM supplier)"""

PLACES_SQL = COMMUNES_SQL + """, places AS (
  SELECT c.code AS commune_code, c.nom AS commune_nom, c.cp AS code_postal,
    CAST(n.n_nationkey AS VARCHAR) AS departement_code, n.n_name AS departement_nom,
    r.r_name AS region_nom, 'EPCI ' || e.r_name AS epci_nom, c.population
  FROM (SELECT DISTINCT code, nom, unnest(codes) AS cp, dep, reg, epci, population FROM communes) c
  LEFT JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = c.dep
  LEFT JOIN region r ON CAST(r.r_regionkey AS VARCHAR) = c.reg
  LEFT JOIN region e ON 'E' || CAST(e.r_regionkey AS VARCHAR) = c.epci)"""


# --- offers of the first source -----------------------------------------------------


def coded_offers(spark, sf_dir):
    """Line items as offers: the supplier is the commune, the part the employer."""
    status, flag = F.col("l_linestatus"), F.col("l_returnflag")
    null = F.lit(None).cast("string")
    return table(spark, sf_dir, "lineitem").select(
        # Order and line repeat with other contents, so the id takes in what tells them apart.
        F.concat_ws(
            "-", text("l_orderkey"), text("l_linenumber"), text("l_partkey"), text("l_suppkey"),
            F.date_format("l_shipdate", "yyyyMMdd"), money("l_extendedprice"),
        ).alias("id"),
        F.when(flag == "A", "Alternance data").when(flag == "N", "Data engineer").alias("intitule"),
        F.concat(F.lit("Quantité "), text("l_quantity")).alias("description"),
        F.col("l_shipdate").alias("dateCreation"),
        F.date_add("l_shipdate", F.col("l_linenumber")).cast("timestamp").alias("dateActualisation"),
        F.when(status == "O", "CDI").otherwise("CDD").alias("typeContrat"),
        F.when(F.col("l_tax") > 0.04, "E").otherwise("D").alias("experienceExige"),
        F.struct(
            F.lit("Lieu").alias("libelle"),
            null.alias("codePostal"),
            F.when(F.col("l_discount") < 0.09, F.concat(F.lit(" "), text("l_suppkey"), F.lit(" ")))
            .otherwise("  ")
            .alias("commune"),
        ).alias("lieuTravail"),
        F.struct(
            F.when(F.col("l_quantity") > 20, F.concat(F.lit("Société "), text("l_partkey"))).otherwise(" ").alias("nom"),
            null.alias("description"),
        ).alias("entreprise"),
        F.struct(salary_text().alias("libelle"), null.alias("commentaire")).alias("salaire"),
        flag.alias("codeNAF"),
        status.alias("secteurActiviteLibelle"),
    )


def salary_text():
    """Yearly range, monthly amount, free text or nothing, by flag and status."""
    status, flag = F.col("l_linestatus"), F.col("l_returnflag")
    low = money("l_extendedprice")
    high = (F.col("l_extendedprice").cast("decimal(18,2)") + F.lit(1000)).cast("decimal(18,2)").cast("string")
    return (
        F.when((status == "O") & (flag == "A"), F.concat(F.lit("Annuel de "), low, F.lit(" Euros à "), high, F.lit(" Euros sur 12.0 mois")))
        .when((status == "O") & (flag == "N"), F.concat(F.lit("Mensuel de "), low, F.lit(" Euros sur 13.0 mois")))
        .when((status == "F") & (flag == "A"), F.lit("  "))
        .when((status == "F") & (flag == "N"), F.lit("Selon profil"))
    )


CODED_SQL = """offers AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
      || '-' || CAST(l_suppkey AS VARCHAR) || '-' || strftime(l_shipdate, '%Y%m%d') || '-'
      || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS offer_id,
    CASE l_returnflag WHEN 'A' THEN 'Alternance data' WHEN 'N' THEN 'Data engineer' END AS job_title,
    CAST(l_shipdate AS DATE) AS created, CAST(l_shipdate AS DATE) + CAST(l_linenumber AS INTEGER) AS updated,
    CASE WHEN l_linestatus = 'O' THEN 'CDI' ELSE 'CDD' END AS contract_type,
    CASE WHEN l_discount < 0.09 THEN CAST(l_suppkey AS VARCHAR) END AS commune,
    CASE WHEN l_quantity > 20 THEN 'Société ' || CAST(l_partkey AS VARCHAR) END AS employer_name,
    CASE WHEN l_linestatus = 'O' AND l_returnflag = 'A' THEN 'Annuel de ' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)
           || ' Euros à ' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) + 1000 AS VARCHAR) || ' Euros sur 12.0 mois'
         WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 'Mensuel de ' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || ' Euros sur 13.0 mois'
         WHEN l_linestatus = 'F' AND l_returnflag = 'N' THEN 'Selon profil' END AS salary_label,
    CASE WHEN l_linestatus = 'O' AND l_returnflag = 'A' THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE)
         WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) * 13 END AS low_year,
    CASE WHEN l_linestatus = 'O' AND l_returnflag = 'A' THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) + 1000 AS DOUBLE)
         WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) * 13 END AS high_year,
    l_returnflag AS naf_code, l_linestatus AS industry_label,
    CASE WHEN l_tax > 0.04 THEN 'E' ELSE 'D' END AS experience_required
  FROM lineitem)"""


# --- offers of the second source ----------------------------------------------------


def named_offers(spark, sf_dir):
    """Orders as offers: city and department come as a list of names."""
    status = F.col("o_orderstatus")
    city = F.concat(F.lit("VILLE "), F.right(text("o_orderkey"), F.lit(1)))
    department = F.concat(F.lit("nation_"), text(F.col("o_custkey") % 25))
    place = F.lit("France")
    area = (
        F.when(status == "P", F.array(place, city))
        .when(status == "F", F.array(place, department, city))
        .when(F.col("o_orderpriority") != "5-LOW", F.array(place, F.lit("X"), department, city))
        .otherwise(F.array(place))
    )
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("title"),
        F.lit("d").alias("description"),
        F.col("o_orderdate").alias("created"),
        F.lit(None).cast("string").alias("redirect_url"),
        F.lit("0").alias("salary_is_predicted"),
        F.lit("full_time").alias("contract_time"),
        status.alias("contract_type"),
        F.when(price > 100000, price).alias("salary_min"),
        F.when(price > 200000, price).alias("salary_max"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        F.struct(text("o_custkey").alias("display_name")).alias("company"),
        F.struct(F.array_join(area, ", ").alias("display_name"), area.alias("area")).alias("location"),
        F.struct(F.lit("IT").alias("label")).alias("category"),
    )


NAMED_SQL = """named AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS offer_id, o_orderpriority AS job_title, o_orderstatus AS status,
    CASE WHEN o_orderstatus IN ('P', 'F') OR o_orderpriority <> '5-LOW'
         THEN 'VILLE ' || right(CAST(o_orderkey AS VARCHAR), 1) END AS city,
    CASE WHEN o_orderstatus = 'F' OR (o_orderstatus NOT IN ('P', 'F') AND o_orderpriority <> '5-LOW')
         THEN 'nation_' || CAST(o_custkey % 25 AS VARCHAR) END AS dept,
    CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END AS has_salary_info
  FROM orders), name_index AS (
  SELECT upper(commune_nom) AS nom_upper, upper(departement_nom) AS dep_upper,
    max(commune_code) AS commune_code, max(commune_nom) AS commune_nom, max(code_postal) AS code_postal,
    max(departement_code) AS departement_code, max(departement_nom) AS departement_nom,
    max(region_nom) AS region_nom, max(epci_nom) AS epci_nom
  FROM places GROUP BY 1, 2)"""


# --- employers ----------------------------------------------------------------------


def employer_rows(spark, sf_dir):
    """Customers as offers that name an employer in a place."""
    return table(spark, sf_dir, "customer").select(
        text("c_custkey").alias("offer_id"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("Compagnie N° "), F.right("c_name", F.lit(3)), F.lit(" SARL")))
        .otherwise(" ")
        .alias("employer_name"),
        text("c_nationkey").alias("postal_code"),
        F.col("c_mktsegment").alias("naf_code"),
    )


def register_rows(spark, sf_dir):
    """Suppliers as register entries."""
    return table(spark, sf_dir, "supplier").select(
        F.lpad(text("s_suppkey"), 14, "0").alias("siret"),
        F.lpad(text("s_suppkey"), 9, "0").alias("siren"),
        F.concat(F.lit("COMPAGNIE n "), F.right("s_name", F.lit(3)), F.lit(" SAS")).alias("legal_name"),
        text("s_nationkey").alias("postal_code"),
    )


EMPLOYERS_SQL = """employers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS offer_id,
    CASE WHEN c_acctbal > 0 THEN 'COMPAGNIE N ' || right(c_name, 3) END AS name,
    CAST(c_nationkey AS VARCHAR) AS postal_code, c_mktsegment AS naf_code
  FROM customer), candidates AS (
  SELECT name, postal_code, naf_code, CAST(count(*) AS BIGINT) AS offer_count
  FROM employers WHERE name IS NOT NULL GROUP BY 1, 2, 3), entries AS (
  SELECT name, postal_code, min(siret) AS siret FROM (
    SELECT lpad(CAST(s_suppkey AS VARCHAR), 14, '0') AS siret, 'COMPAGNIE N ' || right(s_name, 3) AS name,
      CAST(s_nationkey AS VARCHAR) AS postal_code FROM supplier) GROUP BY 1, 2), best AS (
  SELECT name, postal_code, siret, edits, entry_name FROM (
    SELECT w.name, w.postal_code, e.siret, e.name AS entry_name, levenshtein(w.name, e.name) AS edits,
      row_number() OVER (PARTITION BY w.name, w.postal_code ORDER BY levenshtein(w.name, e.name), e.siret) AS rn
    FROM (SELECT DISTINCT name, postal_code FROM candidates) w
    JOIN entries e ON e.postal_code = w.postal_code
      AND levenshtein(w.name, e.name) <= greatest(1, greatest(length(w.name), length(e.name)) * 15 // 100)) WHERE rn = 1), matches AS (
  SELECT c.*, b.siret, CASE WHEN b.edits = 0 THEN 'exact' WHEN b.edits > 0 THEN 'fuzzy' END AS match_method,
    CASE WHEN b.edits = 0 THEN 1.0 WHEN b.edits > 0 THEN round(1 - b.edits / greatest(length(c.name), length(b.entry_name)), 4) END AS match_confidence,
    CASE WHEN b.siret IS NULL THEN 'unmatched' ELSE 'matched' END AS match_status
  FROM candidates c LEFT JOIN best b ON b.name = c.name AND b.postal_code = c.postal_code)"""
