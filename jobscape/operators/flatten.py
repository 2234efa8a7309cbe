"""Flat tables out of nested records, planned from the schema on the driver."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F, types as T

from jobscape.functions.text import as_text, normalize_value


def _leaves(
    schema: T.StructType, parent: Column | None, path: tuple[str, ...], depth: int | None, keep: bool
) -> Iterator[tuple[tuple[str, ...], Column, T.DataType]]:
    for field in schema.fields:
        here = (*path, field.name)
        value = F.col(f"`{field.name}`") if parent is None else parent.getField(field.name)
        nested = isinstance(field.dataType, T.StructType)
        inside = nested and (depth is None or len(here) <= depth)
        if keep or not inside:
            yield here, value, field.dataType
        if inside:
            yield from _leaves(field.dataType, value, here, depth, keep)


def flatten_record(
    df: DataFrame,
    sep: str = "__",
    max_depth: int | None = None,
    keep_parent: bool = False,
    empty_list_null: bool = False,
    null_as: str | None = None,
) -> DataFrame:
    """Struct fields as top-level columns named by their path; lists as JSON text.

    ``max_depth`` levels of structs are opened (all by default), deeper ones stay as JSON
    text. ``keep_parent`` keeps the opened struct as JSON text too. ``empty_list_null``
    turns empty lists into nulls. ``null_as`` makes every column text, with that text for
    nulls.
    """
    columns = []
    for path, value, kind in _leaves(df.schema, None, (), max_depth, keep_parent):
        name = kind.simpleString()
        if empty_list_null and isinstance(kind, T.ArrayType):
            value = F.when(F.array_size(value) > 0, value)
        if null_as is not None:
            text = as_text(value, name)
            value = text if null_as == "" else F.when(value.isNull(), null_as).otherwise(text)
        elif isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
            value = normalize_value(value, name)
        columns.append(value.alias(sep.join(path)))
    return df.select(*columns)


def all_text(df: DataFrame) -> DataFrame:
    """Every column as text: null as '', nested values as JSON."""
    return df.select(*[as_text(F.col(f"`{f.name}`"), f.dataType.simpleString()).alias(f.name) for f in df.schema.fields])


def normalize_columns(df: DataFrame) -> DataFrame:
    """Booleans as 0/1, nested values as JSON text, the rest as it is."""
    return df.select(
        *[normalize_value(F.col(f"`{f.name}`"), f.dataType.simpleString()).alias(f.name) for f in df.schema.fields]
    )
