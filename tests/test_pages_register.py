from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from jobscape import schemas
from jobscape.functions.html import html_select
from jobscape.operators import matching, pages, register

PAGE = """<html><head><script>var x = "<dl><dt>no</dt></dl>";</script></head><body><!-- <dl><dt>no</dt></dl> -->
<div class="co-legal-board wide"><dl><dt>Forme juridique</dt><dd><button>i</button><template> SAS &amp; Cie
 </template></dd></dl><dl><dt>Capital social</dt><dd>4 615,00 €</dd></dl></div>
<article class="ui-wrap"><div><div><dt>Activité principale déclarée</dt><dd><template>Conseil</template></dd></div>
<div><dt>Type d'activité</dt><dd></dd></div></div></article>
<ul><li data-type="revenue"><span>CA</span><span>3 %</span><span>12 345 000,00</span><span>9</span>
<li data-type="netIncome"><span>2 718 000,50</span></ul>
<div class="ui-tag" data-score="731">x</div>
<ul id="coSovereigntyBoard"><li><div>Gouvernance</div><div>50/100</div><li><div>Achats</div><div>--/100</div></ul>
<select data-co-score="1"><option value="2023" data-scores="A;A;A">2023<option value="2024" data-scores="C;;B">2024</select>
</body></html>"""
AS_OF = dt.date(2026, 4, 6)


@pytest.fixture
def page(spark):
    return spark.createDataFrame([("p1", PAGE), ("p2", "<p>nothing here"), ("p3", None)], "page_id string, html string")


def test_facts(page, rows):
    got = {r["label"]: r["value"] for r in pages.page_facts(page).collect()}
    assert got == {
        "Forme juridique": "SAS & Cie", "Capital": "4 615,00 €", "Activité principale déclarée": "Conseil",
        "Chiffre d'affaires": "12 345 000,00", "Résultats net": "2 718 000,50", "Bilan carbone": "731 tCO2e",
    }


def test_scores(page, rows):
    assert rows(pages.sector_scores(page).select("page_id", "label", "score")) == [("p1", "Gouvernance du secteur", "50/100")]
    assert rows(pages.impact_scores(page, AS_OF)) == [("p1", "2024", "C", None, "B")]


def test_pages_of_one_file_are_shared_out(spark):
    """A small file of many pages is one task; walking them is not."""
    html = F.concat(F.lit('<div class="ui-tag" data-score="'), F.col("id"), F.lit('"></div>'))
    stock = spark.range(0, 400, 1, 1).select(F.col("id").alias("page_id"), html.alias("html"))
    for found in (pages.page_facts(stock), pages.company_sheet(stock, AS_OF), pages.sector_scores(stock), pages.impact_scores(stock, AS_OF)):
        assert found.rdd.getNumPartitions() == 4
    got = pages.page_facts(stock).select("page_id", "value", F.spark_partition_id().alias("part")).collect()
    assert sorted((r["page_id"], r["value"]) for r in got) == [(i, f"{i} tCO2e") for i in range(400)]
    assert max(sum(r["part"] == p for r in got) for p in range(4)) < 200


def test_sheet(page):
    (got,) = pages.company_sheet(page, AS_OF).collect()
    assert got["Résultats net"] == 2718000.5 and got["Type d'activité"] is None
    assert [tuple(s) for s in got["sector_scores"]] == [("Gouvernance du secteur", "50/100")]


def test_blank_carbon_score_keeps_the_unit(spark):
    df = spark.createDataFrame([("p", '<div class="ui-tag" data-score=""></div>')], "page_id string, html string")
    assert pages.page_facts(df).first()["value"] == " tCO2e"


@pytest.mark.parametrize(
    "html, selector, texts",
    [
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", "li", ["a", "bc", "c"]),
        ("<div id=x class='a b'>1</div><div class=a>2</div>", "div.a.b", ["1"]),
        ("<div id=x>1</div>", "#x", ["1"]),
        ("<p data-k='v'>1<p data-k>2", 'p[data-k="v"]', ["1"]),
        ("<p data-k='v'>1<p data-k>2", "p[data-k]", ["1", "2"]),
        ("<nav><a>1</a></nav><a>2</a>", "nav a", ["1"]),
        ("<h1>&eacute;  <b>x\n</b></h1>", "h1", ["é x"]),
        ("</p><br/><p>1<br>2", "p", ["12"]),
    ],
)
def test_html_select(spark, html, selector, texts):
    got = spark.createDataFrame([(html,)], "h string").select(html_select("h", [selector]).alias("e")).first()["e"]
    assert [e["text"] for e in got] == texts


def test_unsupported_selector():
    with pytest.raises(ValueError, match="unsupported selector"):
        html_select(F.lit(""), ["a > b"])


def test_label_pivot_and_first_item(spark, rows):
    df = spark.createDataFrame([(1, "a", "x", 2), (1, "a", "y", 1), (1, "z", "q", 0), (2, "b", "w", 5)], "k int, label string, value string, pos int")
    assert rows(pages.label_pivot(df, ["k"], "label", "value", ["a", "b"])) == [(1, "y", None), (2, None, "w")]
    assert rows(pages.first_item(df, ["k"], "value", "pos")) == [(1, "q"), (2, "w")]


# --- register ---------------------------------------------------------------------


@pytest.fixture
def stock(spark):
    def entry(siret, name, last, naf, city, postal, state):
        department = "2A" if postal.startswith("201") else postal[:2]
        return (siret, siret[:9], "2020-01-01", None, department, (name, last, "Ida", naf, state, None), ("3", None, "RUE X", postal, city), [])

    return spark.createDataFrame(
        [
            entry("00000000000003", "MOULINEX SAS", None, "29.10Z", "AJACCIO-PLAGE", "20100", "A"),
            entry("00000000000001", "LES AMIS DE MOULINEX  SAS", None, "94.99Z", "PARIS", "75008", "F"),
            entry("00000000000002", None, "MOULINEX", "62.01Z", "PARIS", "75008", "A"),
            entry("00000000000004", "MOULINEXSAS", None, "62.02A", "LYON", "69001", None),
        ],
        schemas.REGISTER,
    )


@pytest.mark.parametrize(
    "criteria, last_digits",
    [
        ({"name": "moulinex sas"}, "13"),
        ({"name": "moulinex"}, "123"),
        ({"name": "moulinex", "state": "active"}, "23"),
        ({"name": "moulinex", "state": "closed"}, "1"),
        ({"activity": "62.0*"}, "24"),
        ({"activity": "29.10Z"}, "3"),
        ({"city": "paris"}, "12"),
        ({"city": "ajaccio*"}, ""),
        ({"city": "ajaccio*", "city_exact": False}, "3"),
        ({"postal_code": "75008", "activity": "94.99Z"}, "1"),
        ({"department": "69"}, "4"),
        ({"department": "2a"}, "3"),
        ({"department": "20"}, ""),
        ({"name": "moulinex", "limit": 2}, "12"),
    ],
)
def test_register_search(stock, criteria, last_digits):
    got = register.register_search(stock, **criteria)
    assert "".join(sorted(r["siret"][-1] for r in got.collect())) == last_digits


def test_search_needs_a_criterion(stock):
    with pytest.raises(ValueError, match="at least one"):
        register.register_search(stock, state="active")


def test_search_text_is_literal(stock):
    assert register.register_search(stock, name="MOULINEX.*").count() == 3
    with pytest.raises(ValueError):
        register.register_search(stock, name=".*")


def test_establishment_rows(stock):
    got = register.establishment_rows(stock).filter("siret like '%2'").first()
    assert (got["nom_complet"], got["enseigne"], got["etat"], got["adresse"], got["effectifs"]) == (
        "Ida MOULINEX", "", "Actif", "3 RUE X", "Non renseigné",
    )
    shown = register.display_columns(register.establishment_rows(stock), ["siret", "etat"])
    assert shown.columns == ["SIRET", "État Admin."]


# --- matching ---------------------------------------------------------------------


@pytest.mark.parametrize(
    "name, wanted",
    [("Société Générale S.A.", "SOCIETE GENERALE S A"), ("  ACME sas ", "ACME"), ("SA SAS Acme SARL", "ACME"), ("Sarla", "SARLA"), ("-", None), ("SAS", None), (None, None)],
)
def test_normalize_name(spark, name, wanted):
    df = spark.createDataFrame([(name,)], "n string").select(matching.normalize_name("n").alias("n"))
    assert df.first()["n"] == wanted


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_match_equals_brute_force(spark):
    import random

    rng = random.Random(7)
    word = lambda: "".join(rng.choice("AB") for _ in range(rng.randrange(1, 8)))
    wanted = sorted({(word(), rng.choice(["1", "2"])) for _ in range(120)})
    listed = [(f"{i:014d}", word(), rng.choice(["1", "2"])) for i in range(80)]
    candidates = spark.createDataFrame(
        [(str(i), n, p) for i, (n, p) in enumerate(wanted)],
        "employer_candidate_id string, normalized_employer_name string, postal_code string",
    )
    stock = spark.createDataFrame([(s, s[:9], n, p) for s, n, p in listed], "siret string, siren string, legal_name string, postal_code string")
    got = {
        (r["normalized_employer_name"], r["postal_code"]): (r["siret"], r["match_method"])
        for r in matching.match_employers(candidates, stock).collect()
    }
    expected = {}
    for name, postal in wanted:
        near = sorted((edits(name, n), s) for s, n, p in listed if p == postal and edits(name, n) <= 1)
        expected[name, postal] = (near[0][1], "fuzzy" if near[0][0] else "exact") if near else (None, None)
    assert got == expected


@pytest.mark.parametrize("least_percent", [75, 85])
def test_match_by_ratio_equals_brute_force(spark, least_percent):
    import random

    rng = random.Random(least_percent)
    stems = ["MENUISERIE DURAND ET FILS", "BOULANGERIE DU CENTRE", "TRANSPORTS MARTIN", "GARAGE DE LA GARE 12", "A B C", "AAAAAAAAAAAA"]

    def changed(text):
        letters = list(text)
        for _ in range(rng.randint(0, 7)):
            at = rng.randrange(len(letters) + 1)
            letters[at : at + rng.randint(0, 1)] = rng.choice(["", "X", "A", "E 1"])
        return " ".join("".join(letters).split()) or "Z"

    wanted = sorted({(changed(rng.choice(stems)), rng.choice(["1", "2"])) for _ in range(150)})
    listed = [(f"{i:014d}", changed(rng.choice(stems)), rng.choice(["1", "2", "3"])) for i in range(150)]
    candidates = spark.createDataFrame(
        [(str(i), n, p) for i, (n, p) in enumerate(wanted)],
        "employer_candidate_id string, normalized_employer_name string, postal_code string",
    )
    stock = spark.createDataFrame([(s, s[:9], n, p) for s, n, p in listed], "siret string, siren string, legal_name string, postal_code string")
    got = {
        (r["normalized_employer_name"], r["postal_code"]): (r["siret"], r["match_confidence"])
        for r in matching.match_employers(candidates, stock, least_percent=least_percent).collect()
    }
    expected = {}
    for name, postal in wanted:
        near = []
        for siret, other, p in listed:
            n, longer = edits(name, other), max(len(name), len(other))
            if p == postal and n <= max(1, (100 - least_percent) * longer // 100):
                near.append((n, siret, round(1 - n / longer, 4)))
        expected[name, postal] = min(near)[1:] if near else (None, None)
    assert got == expected and any(c and c < 1 - 1 / 20 for _, c in got.values())


def test_few_pairs_meet_within_a_postal_code(spark):
    import random

    rng = random.Random(5)
    names = sorted({"".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(20)) for _ in range(600)})
    near = [n[:3] + "0" + n[4:12] + "00" + n[14:] for n in names]
    left = spark.createDataFrame([(n, "1") for n in near], "name string, postal string")
    right = spark.createDataFrame([(n, "1") for n in names], "other string, postal string")
    met = matching.ratio_candidates(left, right, "name", "other", "postal", 85)
    assert met.distinct().filter("levenshtein(name, other) = 3").count() == len(names)
    assert met.count() < 600 * 600 / 20
    with pytest.raises(ValueError, match="70 percent"):
        matching.ratio_candidates(left, right, "name", "other", "postal", 60)


def test_pending(spark, rows):
    c = spark.createDataFrame([("1",), ("2",)], "employer_candidate_id string")
    assert rows(matching.pending_candidates(c, c.filter("employer_candidate_id = '1'"))) == [("2",)]
