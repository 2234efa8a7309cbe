from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from jobscape.functions import figures, text as tx


@pytest.fixture
def value(spark):
    def of(expression, **columns):
        frame = spark.range(1).select(*[v.alias(k) if hasattr(v, "alias") else F.lit(v).alias(k) for k, v in columns.items()] or ["id"])
        return frame.select(expression.alias("x")).first()["x"]

    return of


NBSP, ZERO_WIDTH, SOFT_HYPHEN = chr(0xA0), chr(0x200B), chr(0xAD)


@pytest.mark.parametrize("space", [" ", "\t", "\n", "\r", "\x0b", NBSP, chr(0x202F), chr(0x2003), chr(0x3000)])
def test_unicode_trim(value, space):
    assert value(tx.clean_trim("a", "unicode"), a=f"{space} x {space}") == "x"
    assert value(tx.null_if_blank("a", "unicode"), a=space * 2) is None


def test_space_trim_keeps_tabs(value):
    assert value(tx.clean_trim("a"), a=" \ta ") == "\ta"


@pytest.mark.parametrize("given, wanted", [("12", 12), (" 12 ", 12), ("12a", None), ("", None), (" ", None), (None, None)])
def test_whole_number(value, given, wanted):
    assert value(tx.to_whole_number("a"), a=F.lit(given).cast("string")) == wanted


@pytest.mark.parametrize("title, flag", [("Alternance", 1), ("en ALTERNANCE", 1), ("Dev", 0), (None, 0)])
def test_keyword_flag(value, title, flag):
    assert value(tx.keyword_flag("a", "Alternance"), a=F.lit(title).cast("string")) == flag


@pytest.mark.parametrize(
    "area, city, department",
    [(["F"], None, None), (["F", "C"], "C", None), (["F", "D", "C"], "C", "D"), (["F", "R", "D", "C"], "C", "D"), (None, None, None), ([], None, None)],
)
def test_area(value, area, city, department):
    given = F.lit(None).cast("array<string>") if area is None else F.array(*[F.lit(a) for a in area]).cast("array<string>")
    assert value(tx.area_city("a"), a=given) == city
    assert value(tx.area_department("a"), a=given) == department


@pytest.mark.parametrize("label, city, department", [("Lyon , Rhône, F", "Lyon", "Rhône, F"), ("Lyon", "Lyon", None), (", x", "", "x"), (None, None, None)])
def test_label(value, label, city, department):
    given = F.lit(label).cast("string")
    assert value(tx.label_city("a"), a=given) == city
    assert value(tx.label_department("a"), a=given) == department


@pytest.mark.parametrize("header, total", [("offres 0-149/2320", 2320), ("offres", 7), (None, 7), ("a/b", 7)])
def test_total_from_range(value, header, total):
    assert value(tx.total_from_range("h", "n"), h=F.lit(header).cast("string"), n=F.lit(7)) == total


@pytest.mark.parametrize("a, b, label", [("x", "y", "x"), ("", "y", "y"), (None, "", ""), (None, None, "unknown_search")])
def test_first_of(value, a, b, label):
    assert value(tx.first_of("a", "b"), a=F.lit(a).cast("string"), b=F.lit(b).cast("string")) == label


def test_strip_invisible(value):
    assert value(tx.strip_invisible("a"), a=f"a{NBSP}b{ZERO_WIDTH}c{SOFT_HYPHEN}d{chr(0xFEFF)}") == "a bcd"


@pytest.mark.parametrize("n", [119, 120, 121])
def test_example_text(value, n):
    got = value(tx.example_text("a"), a="x" * n)
    assert got == "x" * min(n, 120) + ("..." if n > 120 else "")


def test_example_text_escapes_newlines(value):
    assert value(tx.example_text("a"), a=" a\nb ") == "a\\nb"


@pytest.mark.parametrize(
    "given, wanted",
    [("2026-04-06T09:58:27.930Z", True), ("2026-04-06T09:58:27Z", True), ("2026-04-06 09:58:27Z", False), ("2026-04-06T09:58:27", False)],
)
def test_iso_timestamp(value, given, wanted):
    assert value(tx.is_iso_timestamp("a"), a=given) is wanted


@pytest.mark.parametrize("given, percent, wanted", [(f"1{NBSP}234,50", False, 1234.5), ("12 %", True, 12.0), ("12 %", False, None), ("1,2,3", False, None)])
def test_fr_number(value, given, percent, wanted):
    assert value(figures.fr_number("a", percent), a=given) == wanted


@pytest.mark.parametrize(
    "cells, wanted",
    [
        (["Gouvernance", "50/100"], ("Gouvernance du secteur", "50/100")),
        (["Gouvernance", "--/100"], None),
        (["", " 50/100 "], None),
        (["--/100", "3/100", "b"], ("b du secteur", "3/100")),
    ],
)
def test_score_cells(value, cells, wanted):
    got = value(figures.score_cells("a"), a=F.array(*[F.lit(c) for c in cells]))
    assert (tuple(got) if got else None) == wanted


def test_split_scores(spark):
    got = spark.createDataFrame([("C;A;",), (None,), ("B",)], "a string").select(*figures.split_scores("a"))
    assert [tuple(r) for r in got.collect()] == [("C", "A", None), (None, None, None), ("B", None, None)]


def test_score_year(value):
    assert value(figures.score_year(dt.date(2026, 4, 6))) == "2024"


@pytest.mark.parametrize(
    "label, wanted",
    [
        ("Annuel de 45000.0 Euros à 50000.0 Euros sur 12.0 mois", ("Annuel", 45000.0, 50000.0, 45000.0, 50000.0)),
        ("Mensuel de 2300.0 Euros sur 12.0 mois", ("Mensuel", 2300.0, 2300.0, 27600.0, 27600.0)),
        ("Mensuel de 2300.0 Euros sur 13.0 mois", ("Mensuel", 2300.0, 2300.0, 29900.0, 29900.0)),
        ("Horaire de 12.5 Euros", ("Horaire", 12.5, 12.5, None, None)),
        ("Annuel de 45000,00 Euros à 50000.0 Euros", ("Annuel", 45000.0, 50000.0, 45000.0, 50000.0)),
        ("Annuel de 45 000.0 Euros à 51\u00a0500,50 Euros", ("Annuel", 45000.0, 51500.5, 45000.0, 51500.5)),
        ("Annuel de 1\u202f000\u202f000 Euros", ("Annuel", 1e6, 1e6, 1e6, 1e6)),
        ("Selon profil", (None, None, None, None, None)),
        (None, (None, None, None, None, None)),
    ],
)
def test_salary(spark, label, wanted):
    df = spark.createDataFrame([(label,)], "a string").select(*figures.salary_bounds("a"))
    assert tuple(df.first()) == wanted


def test_company_name(value):
    none = F.lit(None).cast("string")
    assert value(tx.company_name("n", "f", "l"), n=F.lit(""), f=F.lit("Ida"), l=none) == "Ida"
    assert value(tx.company_name("n", "f", "l"), n=F.lit("Acme"), f=none, l=none) == "Acme"
    assert value(tx.address_line("n", "f", "l"), n=none, f=F.lit("RUE"), l=F.lit("X")) == "RUE X"


@pytest.mark.parametrize("state, label", [("A", "Actif"), ("F", "Fermé"), (None, "Fermé")])
def test_state_label(value, state, label):
    assert value(tx.state_label("a"), a=F.lit(state).cast("string")) == label
