"""Facts out of company pages: label and value pairs, scores, figures."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobscape.functions import figures
from jobscape.functions.html import attribute, html_select, mentions, of_rule
from jobscape.functions.text import _col
from jobscape.operators.scale import spread

# Labels a company page is read for, where they stand, and the marks a
# page must hold to be worth reading.
LEGAL_FORM, CAPITAL = "Forme juridique", "Capital"
ACTIVITY, ACTIVITY_KIND = "Activité principale déclarée", "Type d'activité"
AGREEMENT = "Convention collective déduite"
REVENUE, NET_RESULT, CARBON = "Chiffre d'affaires", "Résultats net", "Bilan carbone"
LABELS = (LEGAL_FORM, CAPITAL, ACTIVITY, ACTIVITY_KIND, AGREEMENT, REVENUE, NET_RESULT, CARBON)
RENAMED_LABELS = {"Capital social": CAPITAL}
SELECTORS = [
    "div.co-legal-board dl dt",
    "div.co-legal-board dl dd",
    "div.co-legal-board dl dd template",
    "article.ui-wrap div div dt",
    "article.ui-wrap div div dd",
    "article.ui-wrap div div dd template",
    'li[data-type="revenue"] span',
    'li[data-type="netIncome"] span',
    "div.ui-tag[data-score]",
    "ul#coSovereigntyBoard li",
    "ul#coSovereigntyBoard li div",
    "select[data-co-score] option",
]
MARKS = ("co-legal-board", "ui-wrap", "data-type=", "data-score", "coSovereigntyBoard", "data-co-score")


def label_pivot(df: DataFrame, keys: Sequence[str], label: str, value: str, known: Sequence[str]) -> DataFrame:
    """One row per key with a column per known label, holding its largest value."""
    return df.filter(F.col(label).isin(list(known))).groupBy(*keys).pivot(label, list(known)).agg(F.max(value))


def first_item(df: DataFrame, keys: Sequence[str], value: str, pos: str) -> DataFrame:
    """The value at the lowest position per key."""
    return df.groupBy(*keys).agg(F.min_by(value, pos).alias(value))


def split_out(df: DataFrame, items: Column | str, pos: str = "pos", item: str = "item") -> DataFrame:
    """One row per element of a list column, with its position."""
    return df.select("*", F.posexplode(_col(items)).alias(pos, item))


def paired(labels: Column, values: Column, texts: Column) -> Column:
    """(label, value) of every enclosing element: its first label, and its first value,
    taken from the inner text where there is one."""
    in_scope = lambda group, e: F.get(F.filter(group, lambda v: v["scope"] == e["scope"]), F.lit(0))

    def pair(e):
        outer = in_scope(values, e)
        inner = F.get(F.filter(texts, lambda t: t["scope"] == outer["pos"]), F.lit(0))
        return F.struct(
            e["text"].alias("label"), F.coalesce(inner["text"], outer["text"]).alias("value"), e["pos"].alias("pos")
        )

    heads = F.filter(labels, lambda e: in_scope(labels, e)["pos"] == e["pos"])
    return F.transform(heads, pair)


def _figure(spans: Column, label: str) -> Column:
    """The first amount among the spans of a figure, percentages left out."""
    amounts = F.filter(spans, lambda e: figures.starts_numeric(e["text"]) & ~figures.has_percent(e["text"]))
    return F.transform(
        F.slice(amounts, 1, 1),
        lambda e: F.struct(F.lit(label).alias("label"), e["text"].alias("value"), e["pos"].alias("pos")),
    )


def _facts(e: str) -> Column:
    rule = lambda i: of_rule(e, i)
    carbon = F.transform(
        F.slice(rule(8), 1, 1),
        lambda x: F.struct(
            F.lit(CARBON).alias("label"),
            figures.suffix_unit(attribute(x, "data-score")).alias("value"),
            x["pos"].alias("pos"),
        ),
    )
    found = F.concat(
        paired(rule(0), rule(1), rule(2)),
        paired(rule(3), rule(4), rule(5)),
        _figure(rule(6), REVENUE),
        _figure(rule(7), NET_RESULT),
        carbon,
    )

    def named(x):
        label = x["label"]
        for old, new in RENAMED_LABELS.items():
            label = F.when(label == old, new).otherwise(label)
        return F.struct(label.alias("label"), x["value"].alias("value"), x["pos"].alias("pos"))

    return F.filter(F.transform(found, named), lambda x: x["label"].isin(*LABELS) & (x["value"] != ""))


def _board(e: str) -> Column:
    lines, cells = of_rule(e, 9), of_rule(e, 10)
    scored = F.transform(
        lines,
        lambda li: F.struct(
            li["pos"].alias("pos"),
            figures.score_cells(
                F.transform(F.filter(cells, lambda c: c["scope"] == li["pos"]), lambda c: c["text"])
            ).alias("s"),
        ),
    )
    return F.transform(
        F.filter(scored, lambda x: x["s"].isNotNull()),
        lambda x: F.struct(x["pos"].alias("pos"), x["s"]["label"].alias("label"), x["s"]["score"].alias("score")),
    )


def _impact(e: str, as_of: dt.date) -> Column:
    year = figures.score_year(as_of)
    option = F.get(F.filter(of_rule(e, 11), lambda x: attribute(x, "value") == year), F.lit(0))
    return F.when(
        option.isNotNull(), F.struct(year.alias("year"), *figures.split_scores(attribute(option, "data-scores")))
    )


def _elements(pages: DataFrame, page: str, html: str) -> DataFrame:
    # Walking a page costs far more than its bytes tell, so the pages of one file are shared out among many tasks.
    read = spread(pages.select(page, html).filter(mentions(html, *MARKS)), page, html)
    return read.select(page, html_select(html, SELECTORS).alias("e"))


def page_facts(pages: DataFrame, page: str = "page_id", html: str = "html") -> DataFrame:
    """(page, label, value, pos): every known fact of a company page, one row each."""
    return _elements(pages, page, html).select(page, F.inline(_facts("e")))


def sector_scores(pages: DataFrame, page: str = "page_id", html: str = "html") -> DataFrame:
    """(page, pos, label, score): the score board of the sector, one row per scored line."""
    return _elements(pages, page, html).select(page, F.inline(_board("e")))


def impact_scores(pages: DataFrame, as_of: dt.date, page: str = "page_id", html: str = "html") -> DataFrame:
    """(page, year, territorial, social, fiscal) of the year two years before ``as_of``."""
    rows = _elements(pages, page, html).select(page, _impact("e", as_of).alias("s"))
    return rows.filter("s is not null").select(page, "s.*")


def company_sheet(pages: DataFrame, as_of: dt.date, page: str = "page_id", html: str = "html") -> DataFrame:
    """One row per page: a column per label, net result as number, and the scores as lists.

    A page is one row, so everything happens inside it: one read, one shuffle to share the pages out.
    """
    rows = _elements(pages, page, html).select(
        page,
        _facts("e").alias("facts"),
        F.transform(_board("e"), lambda x: F.struct(x["label"].alias("label"), x["score"].alias("score"))).alias(
            "sector_scores"
        ),
        _impact("e", as_of).alias("impact_scores"),
    )
    largest = lambda label: F.array_max(
        F.transform(F.filter("facts", lambda x: x["label"] == label), lambda x: x["value"])
    )
    columns = [
        (figures.fr_number(largest(label)) if label == NET_RESULT else largest(label)).alias(label)
        for label in LABELS
    ]
    return rows.select(page, *columns, "sector_scores", "impact_scores")
