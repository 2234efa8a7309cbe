"""Place lookups: by code, by name, and the lists they need.

No join here carries a broadcast hint. Hand in lists that were read from files or settled
(``sinks.tables.settle``): Spark then knows their size, broadcasts the small ones and
shuffles for the others, splitting hot keys at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobscape.functions.text import fold_upper, json_first
from jobscape.operators.dedupe import keep_first


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct whole rows of the chosen columns; arrays and structs compare by value."""
    return (df.select(*columns) if columns else df).distinct()


def explode_codes(df: DataFrame, codes: str, out: str) -> DataFrame:
    """One row per element of a list column, which is dropped; rows without elements go."""
    kept = [c for c in df.columns if c != codes]
    return df.select(*kept, F.explode(F.col(codes).cast("array<string>")).alias(out))


def first_code(codes: Column | str, as_json: bool = False) -> Column:
    """First element of a list, or of a list held as JSON text; null when empty."""
    if as_json:
        return json_first(codes)
    return F.get(F.col(codes) if isinstance(codes, str) else codes, F.lit(0))


def code_name(df: DataFrame, code: str, name: str, code_as: str, name_as: str) -> DataFrame:
    """Distinct (code, name) pairs of a reference list under new names."""
    return df.select(F.col(code).alias(code_as), F.col(name).alias(name_as)).distinct()


def lookup_left(facts: DataFrame, dims: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Chain of left joins ``(dimension, fact column, dimension column)``.

    Unmatched rows stay, with null names.
    """
    for dim, left, right in dims:
        facts = facts.join(dim, F.col(left) == F.col(right), "left")
    return facts


def name_index(df: DataFrame, keys: dict[str, str], values: Sequence[str]) -> DataFrame:
    """One row per upper-cased key pair with the maximum of each value column.

    The maxima are taken one by one, so a row may mix the values of different places.
    """
    return df.groupBy(*[fold_upper(src).alias(key) for key, src in keys.items()]).agg(
        *[F.max(v).alias(v) for v in values]
    )


def join_by_code(facts: DataFrame, places: DataFrame, left: str, right: str) -> DataFrame:
    """Inner join on a place code. One row per match, so a place listed under several
    postal codes repeats the fact."""
    return facts.join(places, F.col(left) == F.col(right))


def join_by_name(
    facts: DataFrame,
    index: DataFrame,
    city: str,
    department: str,
    city_key: str,
    department_key: str,
) -> DataFrame:
    """Inner join on the upper-cased city, and on the department where the fact names one.

    The city is the hash key; the department test is a filter on its matches. Only a
    missing department on the fact side matches everything.
    """
    same_city = fold_upper(city) == F.col(city_key)
    same_department = (fold_upper(department) == F.col(department_key)) | F.col(department).isNull()
    return facts.join(index, same_city & same_department)


def one_row_per_key(df: DataFrame, key: str, tie: str) -> DataFrame:
    """The row with the smallest ``tie`` per key; the opt-in cure for repeated facts."""
    return keep_first(df, key, [tie])
