"""Answer tables: where, who, at what salary, and when.

These follow a written specification of grain and measures; the formulas are ours.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobscape.functions.figures import salary_bounds
from jobscape.operators.scale import first_per_key
from jobscape.plans.employers import with_employers
from jobscape.plans.geo import PLACE_COLUMNS


def with_places(staged: DataFrame, places: DataFrame) -> DataFrame:
    """Every offer with codes and names of its commune, department, region and body.

    ``places`` is the kept result of ``staged_place_names``: one row per commune, so offers
    are not repeated, and one join for all levels."""
    known = places.withColumnRenamed("commune_code", "_c")
    return staged.join(known, F.col("commune_code") == F.col("_c"), "left").drop("_c")


def int_offer_places(staged: DataFrame, places: DataFrame) -> DataFrame:
    """The place link alone: one row per offer."""
    return with_places(staged, places).select("offer_id", *PLACE_COLUMNS)


def int_offers_enriched(staged: DataFrame, places: DataFrame, matches: DataFrame) -> DataFrame:
    """Offer, salary, place and employer in one row.

    Place and employer are looked up on the staged row itself, so the offers are never
    joined with each other."""
    return with_employers(with_places(staged, places), matches)


def mart_offers(enriched: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The central table: one row per final offer."""
    return enriched.select(*columns) if columns else enriched


def period_of(ts: str, unit: str = "month") -> Column:
    return F.to_date(F.date_trunc(unit, F.col(ts)))


def _place_rows(
    offers: DataFrame,
    levels: Sequence[str],
    ts: str,
    employer: str,
    permanent: Column,
    apprentice: Column,
    salaried: Column,
    unit: str,
) -> DataFrame:
    """Every offer as a count of one, in the columns of ``place_states``."""
    flag = lambda c: F.when(c, 1).otherwise(0)
    return offers.select(
        *levels, period_of(ts, unit).alias("period"), employer, F.lit(1).alias("n"),
        flag(permanent).alias("n_permanent"), flag(apprentice).alias("n_apprentice"), flag(salaried).alias("n_salaried"),
    )


def _place_sums(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return counts.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ("n", "n_permanent", "n_apprentice", "n_salaried")))


def place_states(
    offers: DataFrame,
    levels: Sequence[str],
    ts: str,
    employer: str,
    permanent: Column,
    apprentice: Column,
    salaried: Column,
    unit: str = "month",
) -> DataFrame:
    """Counts per narrowest zone, period and company: what ``places_from_states`` adds up, for all offers or those of a day."""
    return _place_sums(_place_rows(offers, levels, ts, employer, permanent, apprentice, salaried, unit), [*levels, "period", employer])


def mart_places(
    offers: DataFrame,
    levels: Sequence[str],
    ts: str,
    employer: str,
    permanent: Column,
    apprentice: Column,
    salaried: Column,
    unit: str = "month",
) -> DataFrame:
    """Per zone and period: offers, companies, share of permanent and apprentice offers,
    share with a salary. ``levels`` lists zone columns from wide to narrow; there is one
    row set per level.

    Offers are first counted per narrowest zone, period and company; the levels are built
    from those counts, so raw rows are neither repeated per level nor shuffled whole.
    """
    return places_from_states(_place_rows(offers, levels, ts, employer, permanent, apprentice, salaried, unit), levels, employer)


def places_from_states(base: DataFrame, levels: Sequence[str], employer: str) -> DataFrame:
    """The table of ``mart_places`` from its counts, of one day or many together.

    The counts per company of a wide zone are the sums of those of the next narrower one, so a task holds the counts
    of two levels at most, and rows are never repeated per level. A company has one row per zone and period by then.
    """
    share = lambda c: F.round(F.sum(c) / F.sum("n"), 4)
    counts, found = base, None
    for i in reversed(range(len(levels))):
        zones = [*levels[: i + 1], "period"]
        counts = _place_sums(counts, [*zones, employer])
        rows = counts.groupBy(*zones).agg(
            F.sum("n").alias("n_offers"),
            F.count(employer).alias("n_companies"),
            share("n_permanent").alias("permanent_share"),
            share("n_apprentice").alias("apprentice_share"),
            share("n_salaried").alias("salary_share"),
        )
        rows = rows.withColumns({"level": F.lit(levels[i]), **{c: F.lit(None).cast(base.schema[c].dataType) for c in levels[i + 1 :]}}).select(
            "level", *levels, "period", "n_offers", "n_companies", "permanent_share", "apprentice_share", "salary_share"
        )
        found = rows if found is None else rows.unionByName(found)
    return found


def _employer_rows(offers: DataFrame, key: str, fallback: str, zone: str, sector: str, size: str) -> DataFrame:
    """Every offer of a company as a count of one, in the columns of ``employer_states``."""
    return offers.select(
        F.coalesce(key, fallback).alias("employer_key"), F.col(zone).alias("zone"), F.lit(1).alias("n"),
        F.col(sector).alias("sector"), F.col(size).alias("size"),
    ).filter("employer_key is not null")


def _employer_sums(counts: DataFrame) -> DataFrame:
    return counts.groupBy("employer_key", "zone").agg(F.sum("n").alias("n"), F.max("sector").alias("sector"), F.max("size").alias("size"))


def employer_states(offers: DataFrame, key: str, fallback: str, zone: str, sector: str, size: str) -> DataFrame:
    """Counts per company (register key, else fallback) and zone."""
    return _employer_sums(_employer_rows(offers, key, fallback, zone, sector, size))


def employers_from_states(states: DataFrame) -> DataFrame:
    """The table of ``mart_employers`` from its counts, of one day or many together."""
    per_zone = _employer_sums(states)
    return per_zone.groupBy("employer_key").agg(
        F.sum("n").alias("n_offers"),
        F.count("zone").alias("n_zones"),
        F.array_join(F.sort_array(F.collect_list("zone")), ",").alias("zones"),
        F.max("sector").alias("sector"),
        F.max("size").alias("size"),
    )


def mart_employers(
    offers: DataFrame, key: str, fallback: str, zone: str, sector: str, size: str
) -> DataFrame:
    """Per company (register key, else fallback): offers, zones covered, sector, size.

    Rows are first counted per company and zone, so the list of zones is gathered from at
    most one row per zone."""
    return employers_from_states(_employer_rows(offers, key, fallback, zone, sector, size))


def offer_salaries(offers: DataFrame, label: str) -> DataFrame:
    """Offers with the figures read from their salary label; the text stays beside them."""
    return offers.select("*", *salary_bounds(label))


def mart_salaries(offers: DataFrame, label: str, segment: Sequence[str], company: str | None = None) -> DataFrame:
    """Per segment: offers, labels present, labels read, lowest, highest and mean yearly pay, and the salary text.

    The text is the label most offers of the segment carry, the first in the alphabet among equals. With ``company``
    the companies of the segment are counted; a segment may have the company as one of its columns.
    """
    rows = offer_salaries(offers, label)
    middle = (F.col("salary_low_year") + F.col("salary_high_year")) / 2
    # Labels are counted map-side before the commonest is looked for, so a large segment is no single task.
    texts = rows.filter(F.col(label).isNotNull()).groupBy(*segment, label).agg(F.count(F.lit(1)).alias("_n"))
    commonest = first_per_key(texts, segment, [F.col("_n").desc(), F.col(label)])
    commonest = commonest.select(*(F.col(c).alias(f"_{c}") for c in segment), F.col(label).alias("salary_text"))
    figures = rows.groupBy(*segment).agg(
        F.count(F.lit(1)).alias("n_offers"),
        *([F.count_distinct(company).alias("n_companies")] if company else []),
        F.count(label).alias("n_labels"),
        F.count("salary_low_year").alias("n_read"),
        F.round(F.min("salary_low_year"), 2).alias("lowest_year"),
        F.round(F.max("salary_high_year"), 2).alias("highest_year"),
        F.round(F.avg(middle), 2).alias("mean_year"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in segment]
    return figures.join(commonest, same, "left").drop(*(f"_{c}" for c in segment))


def _trend_moments(offers: DataFrame, created: str, updated: str, employer: str, unit: str) -> DataFrame:
    """Both dates of an offer as rows of one stream, each a count of one in the columns of ``trend_states``."""
    moments = F.array(
        F.struct(period_of(created, unit).alias("period"), F.lit(1).alias("n_new"), F.lit(0).alias("n_updated")),
        F.struct(period_of(updated, unit).alias("period"), F.lit(0).alias("n_new"), F.lit(1).alias("n_updated")),
    )
    return offers.select(F.col(employer).alias("company"), F.inline(moments)).filter("period is not null")


def trend_states(offers: DataFrame, created: str, updated: str, employer: str, unit: str = "day") -> DataFrame:
    """Publications and updates per period and company.

    They are counted per company before the companies are counted, so a busy day is spread over many tasks."""
    rows = _trend_moments(offers, created, updated, employer, unit)
    return rows.groupBy("period", "company").agg(F.sum("n_new").alias("n_new"), F.sum("n_updated").alias("n_updated"))


def trend_from_states(states: DataFrame) -> DataFrame:
    """The table of ``mart_trend`` from its counts, of one day or many together.

    Companies are told apart before they are counted, so a busy day is spread over many tasks; only those that
    published are, so a task holds one row for each of them and none for the updates."""
    return states.groupBy("period").agg(
        F.sum("n_new").alias("n_published"),
        F.sum("n_updated").alias("n_updated"),
        F.count_distinct(F.when(F.col("n_new") > 0, F.col("company"))).alias("n_companies"),
    )


def mart_trend(offers: DataFrame, created: str, updated: str, employer: str, unit: str = "day") -> DataFrame:
    """Per day or week: publications, updates, companies that published."""
    return trend_from_states(_trend_moments(offers, created, updated, employer, unit))


class StoredStates:
    """Counts kept per slice of the offers, such as the day they were extracted, under ``root``.

    A new slice is counted from its own offers alone; the answer is made from the counts of all slices. A slice that is
    added again replaces itself.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def add(self, states: DataFrame, name: str) -> None:
        states.write.mode("overwrite").parquet(f"{self.root}/_slice={name}")

    def all(self) -> DataFrame:
        return self.spark.read.option("basePath", self.root).parquet(self.root).drop("_slice")
