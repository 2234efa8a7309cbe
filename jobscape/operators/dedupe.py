"""One row per key out of repeated fetches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobscape.operators.scale import first_per_key, top_per_key


def _asc(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).asc() if isinstance(c, str) else c for c in cols]


def has_key(*keys: str) -> Column:
    """True when every key is present and, as text, not empty."""
    ok = F.lit(True)
    for key in keys:
        ok = ok & (F.col(key).cast("string") != "")
    return ok


def keep_first(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key in the given order; rows without a key are skipped."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return first_per_key(df.filter(has_key(*keys)), keys, _asc(order))


def keep_last(df: DataFrame, keys: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key in the given order; rows without a key are skipped."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return first_per_key(df.filter(has_key(*keys)), keys, [F.col(c).desc() for c in order])


def require_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """The rows as they are; a null key fails the query, as for a primary key.

    The test is part of the key column itself, so no filter can be moved ahead of it."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    missing = F.raise_error(F.lit(f"null in key column {keys}"))
    return df.withColumns({k: F.coalesce(k, missing.cast(df.schema[k].dataType)) for k in keys})


def upsert(
    stored: DataFrame, incoming: DataFrame, keys: str | Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Stored rows replaced or extended by the last incoming row per key; a null key on either side fails the query."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    both = require_keys(stored, keys).withColumn("_new", F.lit(0)).unionByName(
        require_keys(incoming, keys).withColumn("_new", F.lit(1)), allowMissingColumns=True
    )
    return first_per_key(both, keys, [F.col(c).desc() for c in ["_new", *order]]).drop("_new")


def cap_per_search(
    df: DataFrame, search: str | Sequence[str], date: str, tie: Sequence[str], cap: int
) -> DataFrame:
    """The newest ``cap`` rows of every search."""
    keys = [search] if isinstance(search, str) else list(search)
    return top_per_key(df, keys, [F.col(date).desc(), *_asc(tie)], cap)


def extraction_counters(
    fetched: DataFrame, searches: DataFrame, search: str, rank: str, key: str
) -> DataFrame:
    """Per search: rows fetched and keys first seen there, plus a total row.

    ``searches`` lists every search with its ``rank``; ``fetched`` carries the rank too.
    A search that returned nothing has zeros. Duplicates are fetched minus new, so rows
    without a key count as duplicates. The total row has a null search.
    """
    per_search = fetched.groupBy(rank).agg(F.count(F.lit(1)).alias("fetched"))
    # The search that saw a key first is a plain minimum: combined map-side, no window.
    firsts = (
        fetched.filter(has_key(key))
        .groupBy(key)
        .agg(F.min(rank).alias(rank))
        .groupBy(rank)
        .agg(F.count(F.lit(1)).alias("added"))
    )
    counts = (
        searches.select(search, rank)
        .join(per_search, rank, "left")
        .join(firsts, rank, "left")
        .na.fill(0, ["fetched", "added"])
    )
    total = counts.rollup(search).agg(
        F.sum("fetched").alias("fetched"), F.sum("added").alias("added")
    )
    return total.withColumn("duplicates", F.col("fetched") - F.col("added"))
