"""A keyed table in buckets: batches are added as deltas, reading and compaction touch the buckets that changed.

Rows are dealt to buckets by a hash of their key. A batch writes its last row per key to its own folder, a folder per
bucket. A version of the table is a small file that names, for each bucket, the folder of its merged rows and the last
batch they take in; whatever batches are newer count on top. Compaction merges the buckets that have newer batches,
writes them beside the old folders and then a new version, so that readers of the old one are not disturbed.

Layout under the root::

    versions/_v=<n>                                    JSON of the version, one line
    merged/_v=<n>/_bucket=<b>                          rows of a bucket as of version n
    deltas/_run=<query>/_batch=<number>/_bucket=<b>   last rows per key of a batch
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from jobscape.operators.dedupe import keep_last, require_keys
from jobscape.operators.scale import first_per_key

BUCKET, BATCH, RUN = "_bucket", "_batch", "_run"


class KeyedTable:
    """The table under ``root``; ``order`` decides among rows of one key in one batch, the last one stays.

    ``buckets`` counts when the table is made; later it is read from the table, as keys would move otherwise.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], order: Sequence[str], buckets: int = 64):
        self.spark, self.root, self.keys, self.order = spark, root.rstrip("/"), list(keys), list(order)
        stored = self.version()
        if stored is None:
            stored = {"version": 0, "buckets": buckets, "keys": self.keys, "merged": {}, "runs": []}
            self._write_version(stored)
        if stored["keys"] != self.keys:
            raise ValueError(f"{root} is keyed by {', '.join(stored['keys'])}")
        self.buckets = stored["buckets"]

    def _names(self, folder: str, prefix: str) -> list[str]:
        """What follows ``prefix`` in the names inside a folder."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        store = path.getFileSystem(context._jsc.hadoopConfiguration())
        if not store.exists(path):
            return []
        names = [s.getPath().getName() for s in store.listStatus(path)]
        return sorted(n.removeprefix(prefix) for n in names if n.startswith(prefix))

    def _write_version(self, version: dict) -> None:
        line = self.spark.createDataFrame([(json.dumps(version),)], "value string").coalesce(1)
        line.write.mode("errorifexists").text(f"{self.root}/versions/_v={version['version']}")

    def version(self, number: int | None = None) -> dict | None:
        """A version of the table, the newest by default."""
        # A version counts once its file is complete.
        known = [int(n) for n in self._names(f"{self.root}/versions", "_v=") if self._names(f"{self.root}/versions/_v={n}", "_SUCCESS")]
        if number is None and known:
            number = max(known)
        if number not in known:
            return None
        return json.loads(self.spark.read.text(f"{self.root}/versions/_v={number}").first()[0])

    def bucket_of(self, *values: Column | str) -> Column:
        return F.pmod(F.xxhash64(*values), F.lit(self.buckets)).cast("int")

    def add(self, batch: DataFrame, run: str, number: int) -> None:
        """Adds the last row per key of a batch. The same batch may be added again: it replaces its own folder.

        Batches of one run have an order, those of two have none: while a run has batches that no version takes in,
        another one is refused.
        """
        others = [r for r, _ in self._open(self.version()) if r != run]
        if others:
            raise ValueError(f"{self.root} is written by another run; compact it first")
        rows = first_per_key(require_keys(batch, self.keys), self.keys, [F.col(c).desc() for c in self.order])
        dealt = rows.withColumn(BUCKET, self.bucket_of(*self.keys))
        dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.root}/deltas/{RUN}={run}/{BATCH}={number}")

    def _batches(self) -> list[tuple[str, int]]:
        found = []
        for run in self._names(f"{self.root}/deltas", f"{RUN}="):
            folder = f"{self.root}/deltas/{RUN}={run}"
            # A batch counts once it is written whole.
            found += [(run, int(n)) for n in self._names(folder, f"{BATCH}=") if self._names(f"{folder}/{BATCH}={n}", "_SUCCESS")]
        return sorted(found)

    def _open(self, version: dict) -> list[tuple[str, int]]:
        """Batches that some bucket has not taken in."""
        return [(run, n) for run, n in self._batches() if n > self._taken(version, run)]

    @staticmethod
    def _taken(version: dict, run: str) -> int:
        return max((r["batch"] for r in version["runs"] if r["run"] == run), default=-1)

    def changed(self, version: dict | None = None) -> dict[int, list[str]]:
        """The buckets with newer batches, and the folders of these."""
        out: dict[int, list[str]] = {}
        for run, n in self._open(version or self.version()):
            folder = f"{self.root}/deltas/{RUN}={run}/{BATCH}={n}"
            for bucket in self._names(folder, f"{BUCKET}="):
                out.setdefault(int(bucket), []).append(f"{folder}/{BUCKET}={bucket}")
        return out

    def _merged_folder(self, version: dict, bucket: int) -> str | None:
        number = version["merged"].get(str(bucket))
        return None if number is None else f"{self.root}/merged/_v={number}/{BUCKET}={bucket}"

    def _merge(self, version: dict, changed: dict[int, list[str]]) -> DataFrame:
        """The rows of the changed buckets: newer batches win over earlier ones, and any over merged rows."""
        deltas = self.spark.read.option("basePath", f"{self.root}/deltas").parquet(*(p for paths in changed.values() for p in paths))
        rows = deltas.withColumn("_version", F.col(BATCH).cast("bigint")).drop(RUN, BATCH)
        folders = [f for f in (self._merged_folder(version, b) for b in changed) if f]
        if folders:
            base = self.spark.read.option("basePath", f"{self.root}/merged").parquet(*folders)
            rows = rows.unionByName(base.drop("_v").withColumn("_version", F.lit(-1).cast("bigint")), allowMissingColumns=True)
        return keep_last(rows, self.keys, ["_version", *self.order]).drop("_version")

    def rows(self, number: int | None = None) -> DataFrame:
        """The table as of its last batch. Buckets without newer batches are read as they are; only others are merged."""
        version = self.version(number)
        changed = self.changed(version) if number is None else {}
        quiet = [f for f in (self._merged_folder(version, int(b)) for b in version["merged"] if int(b) not in changed) if f]
        parts = []
        if quiet:
            parts.append(self.spark.read.option("basePath", f"{self.root}/merged").parquet(*quiet).drop("_v", BUCKET))
        if changed:
            parts.append(self._merge(version, changed).drop(BUCKET))
        if not parts:
            raise ValueError(f"{self.root} holds no rows yet")
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)

    def compact(self) -> list[int]:
        """Merges the buckets that have newer batches and writes a new version; returns these buckets."""
        version = self.version()
        open_, changed = self._open(version), self.changed(version)
        if not open_:
            return []
        new = version | {"version": version["version"] + 1}
        # One file per bucket; the rows of a bucket are bounded by the number of buckets.
        merged = self._merge(version, changed).repartition(BUCKET)
        merged.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.root}/merged/_v={new['version']}")
        new["merged"] = version["merged"] | {str(b): new["version"] for b in changed}
        runs = {r["run"]: r["batch"] for r in version["runs"]} | {run: n for run, n in open_}
        new["runs"] = [{"run": r, "batch": n} for r, n in sorted(runs.items())]
        self._write_version(new)
        return sorted(changed)


def upsert_keyed_stream(stream: DataFrame, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """Adds everything that has landed to the table, then stops; a repeated batch replaces itself."""

    def add(batch: DataFrame, number: int) -> None:
        table.add(batch, batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"), number)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
