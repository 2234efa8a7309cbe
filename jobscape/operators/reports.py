"""Counts, completion rates and small reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def value_counts(df: DataFrame, column: str, sort: bool = True) -> DataFrame:
    """Rows per value, most frequent first; nulls are left out."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.orderBy(F.desc("n_rows"), column) if sort else counts


def daily_counts(df: DataFrame, ts: str, by: Sequence[str] = (), sort: bool = True) -> DataFrame:
    """Rows per calendar day of a timestamp."""
    counts = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(F.to_date(ts).alias("day"), *by)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return counts.orderBy("day", *by) if sort else counts


def completion_report(df: DataFrame, sort: bool = True) -> DataFrame:
    """Per column: non-null and null rows, and the share filled in percent.

    One aggregation over the table; the unpivot works on its single row.
    """
    names = df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"), *[F.count(F.col(c)).alias(f"_c{i}") for i, c in enumerate(names)]
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"_c{i}").alias("n")) for i, c in enumerate(names)]
    )
    rows = counts.select("_total", F.inline(pairs))
    report = rows.select(
        "column",
        F.col("n").alias("non_null_count"),
        (F.col("_total") - F.col("n")).alias("null_count"),
        F.round(F.try_divide(F.col("n") * 100.0, F.col("_total")), 2).alias("completion_rate"),
    )
    return report.orderBy(F.desc("completion_rate"), "column") if sort else report


def row_counts(**frames: DataFrame) -> DataFrame:
    """Rows per named table."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table"), "n_rows") for n, df in frames.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def sample_non_null(df: DataFrame, column: str, order: Sequence[Column | str], n: int = 5) -> DataFrame:
    """The first n rows that have a value, in the given order."""
    return df.filter(F.col(column).isNotNull()).orderBy(*order).limit(n)


def append_batches(*frames: DataFrame) -> DataFrame:
    """Rows of all batches; columns a batch lacks are null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def latest_batch(df: DataFrame, batch: str) -> DataFrame:
    """Rows of the last batch by name or time."""
    last = df.agg(F.max(batch).alias(batch))
    # One aggregated row: always safe to broadcast.
    return df.join(F.broadcast(last), batch, "left_semi")
