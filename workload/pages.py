"""Elements and facts read from HTML."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from jobscape.functions.html import attribute, html_select, of_rule
from jobscape.operators import pages as ops, register as reg
from workload.tables import money, table, text

AS_OF = dt.date(2026, 4, 6)


def _links(spark, sf):
    return table(spark, sf, "pages").select("page_id", html_select("html", ["nav li a"]).alias("links"))


def page_links(spark, sf):
    rows = ops.split_out(_links(spark, sf), "links", "pos", "link")
    return rows.select(
        "page_id", F.col("pos").cast("bigint").alias("pos"),
        attribute(F.col("link"), "href").alias("href"), F.col("link.text").alias("label"),
    )


def page_headings(spark, sf):
    e = table(spark, sf, "pages").select("page_id", html_select("html", ["title", "h1"]).alias("e"))
    first = lambda i: F.get(of_rule("e", i), F.lit(0))["text"]
    return e.select("page_id", first(0).alias("title"), first(1).alias("heading"))


def page_scripts(spark, sf):
    """Number of paragraphs, links and scripts per page; markup inside scripts is text."""
    e = table(spark, sf, "pages").select("page_id", html_select("html", ["a[href]", "script", "div.ad"]).alias("e"))
    count = lambda i: F.size(of_rule("e", i))
    return e.select("page_id", count(0).alias("n_links"), count(1).alias("n_scripts"), count(2).alias("n_ads"))


def first_item(spark, sf):
    rows = ops.split_out(_links(spark, sf), "links", "pos", "link")
    rows = rows.select("page_id", "pos", attribute(F.col("link"), "href").alias("href"))
    return ops.first_item(rows, ["page_id"], "href", "pos")


def collect_items(spark, sf):
    """The links of a page as one list; a page is one row, so nothing is gathered."""
    labels = F.transform("links", lambda e: e["text"])
    return _links(spark, sf).select("page_id", F.array_join(labels, "|").alias("labels"))


def label_pivot(spark, sf):
    return ops.label_pivot(table(spark, sf, "conversations"), ["conv_id"], "role", "text", ["system", "user", "assistant"])


def _company_pages(spark, sf):
    """Company pages written out from customers."""
    amount = F.replace(money("c_acctbal"), F.lit("."), F.lit(","))
    dl = lambda label, value: F.concat(
        F.lit(f"<dl><dt>{label}</dt><dd><button>?</button><template> "), value, F.lit(" </template></dd></dl>")
    )
    row = lambda label, value: F.concat(F.lit(f"<div><dt>{label}</dt><dd>"), value, F.lit("</dd></div>"))
    spans = lambda kind: F.concat(
        F.lit(f'<li data-type="{kind}"><span>Libellé</span><span>12 %</span><span>'), amount, F.lit("</span><span>7</span></li>")
    )
    line = lambda label, score: F.concat(
        F.lit("<li><div>"), label, F.lit("</div><div>"), score, F.lit("</div></li>")
    )
    body = F.concat(
        F.lit('<html><body><div class="board co-legal-board">'),
        dl("Forme juridique", F.col("c_mktsegment")),
        dl("Capital social", amount),
        dl("Autre", F.lit("x")),
        F.lit('</div><article class="ui-wrap"><div>'),
        row("Activité principale déclarée", F.concat(F.lit("Conseil &amp; "), "c_name")),
        row("Convention collective déduite", F.lit("")),
        F.lit("</div></article><ul>"),
        spans("revenue"),
        spans("netIncome"),
        F.lit('</ul><div class="ui-tag" data-score="'),
        text("c_nationkey"),
        F.lit('"></div><ul id="coSovereigntyBoard">'),
        line(F.lit("Gouvernance"), F.concat(text("c_nationkey"), F.lit("/100"))),
        line(F.lit("Achats"), F.lit("--/100")),
        F.lit('</ul><select data-co-score><option value="2023" data-scores="A;A;A">2023<option value="2024" data-scores="C;'),
        F.left("c_mktsegment", F.lit(1)),
        F.lit(';">2024</select></body></html>'),
    )
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("page_id"), body.alias("html"))


def page_facts(spark, sf):
    return ops.page_facts(_company_pages(spark, sf)).select("page_id", "label", "value")


def sector_scores(spark, sf):
    return ops.sector_scores(_company_pages(spark, sf)).select("page_id", "label", "score")


def impact_scores(spark, sf):
    return ops.impact_scores(_company_pages(spark, sf), AS_OF)


def company_sheet(spark, sf):
    sheet = ops.company_sheet(_company_pages(spark, sf), AS_OF)
    return sheet.select(
        "page_id",
        F.col("Forme juridique").alias("legal_form"),
        F.col("Capital").alias("capital"),
        F.col("`Activité principale déclarée`").alias("activity"),
        F.col("`Convention collective déduite`").alias("agreement"),
        F.col("`Chiffre d'affaires`").alias("revenue"),
        F.col("`Résultats net`").alias("net_result"),
        F.col("`Bilan carbone`").alias("carbon"),
        F.to_json("sector_scores").alias("sector_scores"),
        F.to_json("impact_scores").alias("impact_scores"),
    )


# Where the customer table keeps what a register search asks for.
SEARCH = {
    "name": ("c_name", "nick"),
    "activity": "c_mktsegment",
    "city": "city",
    "postal_code": "postal",
    "department": "department",
    "state": "state",
    "key": "c_custkey",
}


def _register(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_mktsegment",
        F.concat(F.lit("maison "), F.lower("c_mktsegment"), F.lit("-"), text("c_nationkey")).alias("nick"),
        F.concat(F.lit("CITY "), text("c_nationkey")).alias("city"),
        F.lpad(text("c_nationkey"), 5, "0").alias("postal"),
        F.when(F.col("c_nationkey") == 10, "2A").otherwise(text("c_nationkey")).alias("department"),
        F.when(F.col("c_acctbal") > 0, "A").otherwise("F").alias("state"),
    )


def register_search(spark, sf):
    return reg.register_search(
        _register(spark, sf), SEARCH, limit=50, name="Maison Building", activity="B*", state="active"
    ).select("c_custkey", "nick", "city")


def register_search_place(spark, sf):
    return reg.register_search(
        _register(spark, sf), SEARCH, limit=None, city="city 1*", city_exact=False, department="2a", state="closed"
    ).select("c_custkey", "nick", "city")


def establishment_rows(spark, sf):
    """Customers as register records, shown as the flat rows of a search."""
    null = F.lit(None).cast("string")
    records = table(spark, sf, "customer").select(
        text("c_custkey").alias("siret"),
        null.alias("siren"),
        null.alias("dateCreationEtablissement"),
        F.when(F.col("c_nationkey") > 12, text("c_nationkey")).alias("trancheEffectifsEtablissement"),
        F.struct(
            F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("denominationUniteLegale"),
            F.col("c_mktsegment").alias("nomUniteLegale"),
            F.lit("Ida").alias("prenomUsuelUniteLegale"),
            null.alias("activitePrincipaleUniteLegale"),
            F.when(F.col("c_acctbal") > 0, "A").alias("etatAdministratifUniteLegale"),
        ).alias("uniteLegale"),
        F.struct(
            null.alias("numeroVoieEtablissement"),
            F.lit("RUE").alias("typeVoieEtablissement"),
            F.col("c_mktsegment").alias("libelleVoieEtablissement"),
            F.lpad(text("c_nationkey"), 5, "0").alias("codePostalEtablissement"),
            F.lit("PARIS").alias("libelleCommuneEtablissement"),
        ).alias("adresseEtablissement"),
        F.when(F.col("c_nationkey") < 5, F.array().cast("array<struct<enseigne1Etablissement:string>>"))
        .otherwise(F.array(F.struct(F.col("c_name").alias("enseigne1Etablissement"))))
        .alias("periodesEtablissement"),
    )
    return reg.establishment_rows(records)


def display_columns(spark, sf):
    shown = reg.display_columns(establishment_rows(spark, sf), ["siret", "nom_complet", "etat", "ville"])
    return shown.withColumnsRenamed({"Nom / Dénomination": "nom", "État Admin.": "etat"})


QUERIES = {
    "page_links": page_links,
    "page_headings": page_headings,
    "page_elements": page_scripts,
    "first_item": first_item,
    "collect_items": collect_items,
    "label_pivot": label_pivot,
    "page_facts": page_facts,
    "sector_scores": sector_scores,
    "impact_scores": impact_scores,
    "company_sheet": company_sheet,
    "register_search": register_search,
    "register_search_place": register_search_place,
    "establishment_rows": establishment_rows,
    "display_columns": display_columns,
}

AMOUNT = "replace(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), '.', ',')"
IS_FIGURE = f"regexp_matches({AMOUNT}, '^[1-9]')"
FIGURE = f"CASE WHEN {IS_FIGURE} THEN {AMOUNT} ELSE '7' END"
LINK = r"""'<li><a href="([^"]*)">([^<]*)</a></li>'"""


def _plain(x: str) -> str:
    """Entities the pages use, with or without semicolon, and white space, as a browser shows them."""
    for entity, sign in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("amp", "&")):
        x = f"regexp_replace({x}, '&{entity};?', '{sign}', 'g')"
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


ESTABLISHMENTS = """SELECT CAST(c_custkey AS VARCHAR) AS siret, '' AS siren,
  CASE WHEN c_acctbal > 0 THEN c_name ELSE 'Ida ' || c_mktsegment END AS nom_complet,
  CASE WHEN c_nationkey < 5 THEN '' ELSE c_name END AS enseigne, CASE WHEN c_acctbal > 0 THEN 'Actif' ELSE 'Fermé' END AS etat,
  '' AS date_creation, '' AS naf, 'RUE ' || c_mktsegment AS adresse, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS cp,
  'PARIS' AS ville, CASE WHEN c_nationkey > 12 THEN CAST(c_nationkey AS VARCHAR) ELSE 'Non renseigné' END AS effectifs FROM customer"""

ORACLE = {
    "page_links": f"""SELECT page_id, i - 1 AS pos, {_plain('hrefs[i]')} AS href, {_plain('labels[i]')} AS label FROM
      (SELECT page_id, hrefs, labels, unnest(range(1, len(hrefs) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, {LINK}, 1) AS hrefs,
        regexp_extract_all(html, {LINK}, 2) AS labels FROM pages))""",
    "page_headings": f"""SELECT page_id, {_plain("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} AS title,
      {_plain("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")} AS heading FROM pages""",
    "page_elements": """SELECT page_id, CAST(len(regexp_extract_all(html, '<a [^>]*href=')) AS INTEGER) AS n_links,
      CAST(len(regexp_extract_all(html, '<script')) AS INTEGER) AS n_scripts,
      CAST(len(regexp_extract_all(html, '<div class="ad"')) AS INTEGER) AS n_ads FROM pages""",
    "first_item": f"SELECT page_id, {_plain(f'regexp_extract(html, {LINK}, 1)')} AS href FROM pages",
    "collect_items": f"""SELECT page_id, array_to_string([{_plain('x')} FOR x IN regexp_extract_all(html, {LINK}, 2)], '|') AS labels
      FROM pages""",
    "label_pivot": """SELECT conv_id, max(text) FILTER (role = 'system') AS system, max(text) FILTER (role = 'user') AS "user",
      max(text) FILTER (role = 'assistant') AS assistant FROM conversations GROUP BY 1""",
    "page_facts": f"""SELECT c_custkey AS page_id, 'Forme juridique' AS label, c_mktsegment AS value FROM customer
      UNION ALL SELECT c_custkey, 'Capital', {AMOUNT} FROM customer
      UNION ALL SELECT c_custkey, 'Activité principale déclarée', 'Conseil & ' || c_name FROM customer
      UNION ALL SELECT c_custkey, 'Chiffre d''affaires', {FIGURE} FROM customer
      UNION ALL SELECT c_custkey, 'Résultats net', {FIGURE} FROM customer
      UNION ALL SELECT c_custkey, 'Bilan carbone', CAST(c_nationkey AS VARCHAR) || ' tCO2e' FROM customer""",
    "sector_scores": """SELECT c_custkey AS page_id, 'Gouvernance du secteur' AS label, CAST(c_nationkey AS VARCHAR) || '/100' AS score FROM customer""",
    "impact_scores": """SELECT c_custkey AS page_id, '2024' AS year, 'C' AS territorial, left(c_mktsegment, 1) AS social, CAST(NULL AS VARCHAR) AS fiscal
      FROM customer""",
    "company_sheet": f"""SELECT c_custkey AS page_id, c_mktsegment AS legal_form, {AMOUNT} AS capital, 'Conseil & ' || c_name AS activity,
      CAST(NULL AS VARCHAR) AS agreement, {FIGURE} AS revenue, CASE WHEN {IS_FIGURE} THEN round(c_acctbal, 2) ELSE 7 END AS net_result,
      CAST(c_nationkey AS VARCHAR) || ' tCO2e' AS carbon,
      '[{{"label":"Gouvernance du secteur","score":"' || CAST(c_nationkey AS VARCHAR) || '/100"}}]' AS sector_scores,
      '{{"year":"2024","territorial":"C","social":"' || left(c_mktsegment, 1) || '"}}' AS impact_scores FROM customer""",
    "register_search": """SELECT c_custkey, 'maison ' || lower(c_mktsegment) || '-' || CAST(c_nationkey AS VARCHAR) AS nick,
      'CITY ' || CAST(c_nationkey AS VARCHAR) AS city FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 0 ORDER BY c_custkey LIMIT 50""",
    "register_search_place": """SELECT c_custkey, 'maison ' || lower(c_mktsegment) || '-' || CAST(c_nationkey AS VARCHAR) AS nick,
      'CITY ' || CAST(c_nationkey AS VARCHAR) AS city FROM customer WHERE c_nationkey = 10 AND c_acctbal <= 0""",
    "establishment_rows": ESTABLISHMENTS,
    "display_columns": f'SELECT siret AS "SIRET", nom_complet AS nom, etat, ville AS "Ville" FROM ({ESTABLISHMENTS})',
}
