"""Tables and views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from jobscape.operators.dedupe import upsert
from jobscape.operators.flatten import all_text
from jobscape.session import scratch_path


def layer_table(layer: str | None, name: str, default: str = "staging") -> str:
    """Table name inside its layer: the layer as given, else the default one."""
    return f"{layer.strip() if layer else default}.{name}"


def materialize_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Full rebuild of a table."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)


def settle(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    A derived list that many rows are joined to is worked out once, survives the loss of
    executors, and has a size Spark knows: it is broadcast when its files are below
    ``spark.sql.autoBroadcastJoinThreshold`` and joined by shuffle otherwise, where adaptive
    execution splits the partitions that a hot key makes large.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)


def truncate_load(df: DataFrame, name: str) -> None:
    """Replace the rows of a table that must exist; columns are matched by name."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        raise ValueError(f"table {name} does not exist")
    df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)


def replace_table(df: DataFrame, name: str) -> bool:
    """Recreate a table with every column as text; no rows or no columns, no table."""
    if not df.columns or df.isEmpty():
        return False
    materialize_table(all_text(df), name)
    return True


def upsert_path(
    stored: DataFrame, incoming: DataFrame, keys: str | Sequence[str], order: Sequence[str], path: str
) -> DataFrame:
    """Merge the last incoming row per key into the stored rows, written to a new path."""
    upsert(stored, incoming, keys, order).write.mode("errorifexists").parquet(path)
    return incoming.sparkSession.read.parquet(path)


def with_batch_stamp(df: DataFrame, run_id: str, **more: str) -> DataFrame:
    """Run id (and other marks) as columns; the id is given, never taken from the clock."""
    return df.withColumns({"run_id": F.lit(run_id), **{k: F.lit(v) for k, v in more.items()}})


def append_run(df: DataFrame, name: str, run_id: str) -> None:
    """Add the rows of one run to an audit table, partitioned by run."""
    with_batch_stamp(df, run_id).write.mode("append").partitionBy("run_id").saveAsTable(name)


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
