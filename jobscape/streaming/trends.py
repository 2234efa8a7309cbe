"""Publication trend over a stream of offers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def trend_stream(stream: DataFrame, ts: str, delay: str, by: Sequence[str] = (), width: str = "1 day") -> DataFrame:
    """Rows per day (and further keys) of the event time; a day is final once the watermark
    has passed it."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, width).alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.to_date("w.start").alias("day"), *by, "n_rows")
    )
