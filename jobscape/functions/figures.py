"""Numbers, scores and salaries found in text. All JVM-side."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from jobscape.functions.text import ANY_SPACE, _col, clean_trim

# Formats of scores and salary labels.
SCORE = r"^\d+/100$"
NO_SCORE = "--/100"
SECTOR_SUFFIX = " du secteur"
CARBON_UNIT = " tCO2e"
SALARY_AMOUNT = r"(?<![\d.,])((?:\d{1,3}(?:[  \u00a0\u202f]\d{3})+|\d+)(?:[.,]\d+)?)[  \u00a0\u202f]?Euros"
SALARY_MONTHS = r"sur (\d+(?:\.\d+)?) mois"
SALARY_PERIOD = r"^\s*(Annuel|Mensuel|Horaire|Cachet|Autre)"


def fr_number(c: Column | str, percent: bool = False) -> Column:
    """Number written the French way: all spaces out, first comma to a point."""
    t = F.regexp_replace(_col(c), ANY_SPACE + ("|%" if percent else ""), "")
    at = F.instr(t, ",")
    dotted = F.when(
        at > 0, F.concat(F.substring(t, F.lit(1), at - 1), F.lit("."), F.substring(t, at + 1, F.length(t)))
    ).otherwise(t)
    return dotted.try_cast("double")


def starts_numeric(c: Column | str) -> Column:
    return _col(c).rlike("^[1-9]")


def has_percent(c: Column | str) -> Column:
    return _col(c).contains("%")


def score_cells(cells: Column | str) -> Column:
    """Label and score of a row of cells, null unless both are there."""
    filled = F.filter(F.transform(_col(cells), lambda x: clean_trim(x, "unicode")), lambda x: x != "")
    score = F.get(F.filter(filled, lambda x: x.rlike(SCORE)), F.lit(0))
    label = F.get(
        F.filter(filled, lambda x: ~x.rlike(SCORE) & (x != NO_SCORE)), F.lit(0)
    )
    return F.when(
        score.isNotNull() & label.isNotNull(),
        F.struct(F.concat(label, F.lit(SECTOR_SUFFIX)).alias("label"), score.alias("score")),
    )


def split_scores(c: Column | str, names: tuple[str, ...] = ("territorial", "social", "fiscal")) -> list[Column]:
    """One column per part of a ``C;C;B`` text; empty parts are null."""
    parts = F.split(F.coalesce(_col(c), F.lit("")), ";")
    return [F.nullif(F.get(parts, F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)]


def score_year(as_of: dt.date) -> Column:
    """The year two years before ``as_of``, as text."""
    return F.date_format(F.add_months(F.lit(as_of), -24), "yyyy")


def suffix_unit(c: Column | str, unit: str = CARBON_UNIT) -> Column:
    return F.concat(F.coalesce(_col(c), F.lit("")), F.lit(unit))


def salary_period(c: Column | str) -> Column:
    """Pay period named at the start of a salary label, null when unnamed."""
    return F.nullif(F.regexp_extract(_col(c), SALARY_PERIOD, 1), F.lit(""))


def salary_amounts(c: Column | str) -> Column:
    """Every amount of a salary label, as doubles."""
    found = F.regexp_extract_all(_col(c), F.lit(SALARY_AMOUNT), F.lit(1))
    return F.transform(found, lambda x: fr_number(x))


def salary_bounds(c: Column | str) -> list[Column]:
    """Period, lowest and highest amount, and both per year.

    A monthly label is scaled by the months it names (12 when it names none); other
    periods have no yearly value because hours per year are not in the label.
    """
    text = _col(c)
    period, amounts = salary_period(text), salary_amounts(text)
    months = F.coalesce(
        F.nullif(F.regexp_extract(text, SALARY_MONTHS, 1), F.lit("")).try_cast("double"), F.lit(12.0)
    )
    factor = F.when(period == "Annuel", F.lit(1.0)).when(period == "Mensuel", months)
    low, high = F.array_min(amounts), F.array_max(amounts)
    return [
        period.alias("salary_period"),
        low.alias("salary_low"),
        high.alias("salary_high"),
        (low * factor).alias("salary_low_year"),
        (high * factor).alias("salary_high_year"),
    ]
