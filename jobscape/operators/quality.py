"""Checks that return the failing rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from jobscape.schemas import required_columns


class CheckFailed(ValueError):
    """A check returned rows."""


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_unique(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows; null keys are ignored."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (
        df.na.drop(subset=keys)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter("n_rows > 1")
    )


def check_query(df: DataFrame, failing: Column, columns: Sequence[str]) -> DataFrame:
    """Rows for which the predicate holds, reduced to the columns worth reporting."""
    return df.filter(failing).select(*columns)


def check_accepted_values(df: DataFrame, column: str, accepted: Sequence[Any]) -> DataFrame:
    """Values outside the accepted set, with their number of rows; nulls are ignored."""
    return (
        df.filter(~F.col(column).isin(list(accepted)))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def check_required_columns(df: DataFrame, layout: Any) -> DataFrame:
    """Rows with a null in a column the layout requires, and the first such column."""
    first = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required_columns(layout)])
    return df.withColumn("missing_column", first).filter("missing_column is not null")


def require(failing: DataFrame, check: str) -> None:
    """Raise when a check returned rows."""
    if not failing.isEmpty():
        raise CheckFailed(check)
