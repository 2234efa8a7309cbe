"""Landing files into tables, each file once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from jobscape.operators.dedupe import keep_last, require_keys
from jobscape.operators.scale import first_per_key
from jobscape.schemas import struct_of


def landing_stream(
    spark: SparkSession, landing: str, layout: str | T.StructType, archive: str | None = None,
    files_per_batch: int | None = None, pattern: str = "*.ndjson",
) -> DataFrame:
    """New line files of a folder as a stream. With ``archive`` a finished file is moved
    there by the next run; the checkpoint, not the move, keeps files from being read twice."""
    reader = spark.readStream.schema(struct_of(layout)).option("mode", "FAILFAST").option("pathGlobFilter", pattern)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(landing)


def ingest(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has landed to a parquet table, then stop."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(target)
    )


BATCH, RUN = "_batch", "_run"


def upsert_stream(
    stream: DataFrame, root: str, keys: Sequence[str], order: Sequence[str], checkpoint: str
) -> StreamingQuery:
    """Add everything that has landed to the keyed table under ``root``, then stop.

    Each batch writes its last row per key to a folder named by the checkpoint's query and the batch: the cost is
    that of the batch, not of the table, and a repeated batch writes the same folder again. Only one checkpoint may
    write to a root, because batches of two have no order: another one is refused before it writes. ``merged_rows``
    reads the table, ``compact`` rewrites it.
    """
    keys, order = list(keys), list(order)
    spark = stream.sparkSession

    def add(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        others = [r for r in writers(spark, root) if r not in (own, COMPACTED)]
        if others:
            raise ValueError(f"{root} is written by another checkpoint; compact it to a new root first")
        rows = first_per_key(require_keys(batch, keys), keys, [F.col(c).desc() for c in order])
        rows.write.mode("overwrite").parquet(f"{root}/{RUN}={own}/{BATCH}={number}")

    return (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


COMPACTED = "compacted"


def writers(spark: SparkSession, root: str) -> list[str]:
    """The checkpoints whose batches a root holds."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(root)
    store = path.getFileSystem(context._jsc.hadoopConfiguration())
    if not store.exists(path):
        return []
    names = [s.getPath().getName() for s in store.listStatus(path)]
    return [n.removeprefix(f"{RUN}=") for n in names if n.startswith(f"{RUN}=")]


def merged_rows(spark: SparkSession, root: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The keyed table as of its last batch: later batches win over earlier ones, and any over compacted rows."""
    rows = spark.read.option("basePath", root).parquet(root)
    version = F.when(F.col(RUN) == COMPACTED, F.lit(-1)).otherwise(F.col(BATCH)).cast("bigint")
    newest = keep_last(rows.withColumn("_version", version), list(keys), ["_version", *order])
    return newest.drop(BATCH, RUN, "_version")


def compact(spark: SparkSession, root: str, target: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """The merged rows of ``root`` as the base of a new root, to which a new checkpoint may add."""
    merged_rows(spark, root, keys, order).write.mode("errorifexists").parquet(f"{target}/{RUN}={COMPACTED}/{BATCH}=0")


def dedupe_stream(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First arrival per key, for copies at most ``delay`` apart; older keys leave the state."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
