"""Which pages a search needs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# Fixed values of the two offer services.
RANGE_SIZE, PAGE_SIZE, MAX_RESULTS, TEST_RESULTS = 150, 50, 3150, 200


def _planned(totals: DataFrame, total: str, cap: int) -> DataFrame:
    """Searches with something to fetch, and how much; a search of unknown total plans nothing."""
    known = totals.filter(F.col(total) > 0)
    return known.withColumn("_limit", F.least(F.col(total).cast("bigint"), F.lit(cap).cast("bigint"))).filter("_limit > 0")


def page_ranges(
    totals: DataFrame, total: str, cap: int, size: int = RANGE_SIZE
) -> DataFrame:
    """Inclusive row ranges that fetch up to ``cap`` results of every search."""
    planned = _planned(totals, total, cap)
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("_limit") - 1, F.lit(size).cast("bigint"))
    return (
        planned.withColumn("range_start", F.explode(starts))
        .withColumn("range_end", F.least(F.col("range_start") + (size - 1), F.col("_limit") - 1))
        .drop("_limit")
    )


def page_numbers(
    totals: DataFrame, total: str, cap: int, size: int = PAGE_SIZE
) -> DataFrame:
    """Page numbers from 1 that fetch up to ``cap`` results of every search."""
    planned = _planned(totals, total, cap)
    last = F.ceil(F.col("_limit") / size).cast("bigint")
    return planned.withColumn("page", F.explode(F.sequence(F.lit(1).cast("bigint"), last))).drop("_limit")


def search_grid(departments: DataFrame, terms: Sequence[str], term: str = "term") -> DataFrame:
    """Every search term in every department, so that each search stays under the cap."""
    return departments.withColumn(term, F.explode(F.array(*[F.lit(t) for t in terms])))
