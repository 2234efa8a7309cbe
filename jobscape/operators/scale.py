"""First rows per key, also when one key carries a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key. Each map task keeps one row per key before the shuffle."""
    return _ranked(df, keys, order, 1)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows per key, exact for any key size.

    The rows of a key are first cut to n within slices, one per shuffle partition and dealt by map task, and the
    survivors once more. So the last step sees at most n rows per slice of a hot key, and the plan is the same for
    every n and every table.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = df.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(slices)))
    return _ranked(_ranked(sliced, [*keys, "_slice"], order, n).drop("_slice"), keys, order, n)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """The rows dealt over the shuffle partitions by the values of the columns.

    For a costly step on each row: a small file is few tasks, however long its rows take. The number is fixed, as
    adaptive execution would merge partitions by their bytes."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
