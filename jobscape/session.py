"""Session defaults and the shared work folder."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"

# Settings every entry point of this package relies on. Shuffle width and scan
# split size are left to the cluster; tests set them small.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # State of streams outgrows executor memory.
    STATE_STORE: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_local_folders: dict[str, str] = {}


def build_session(
    app: str = "jobscape", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """Session with the package defaults; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextlib.contextmanager
def package_state_store(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in the store of the package, whatever the session was started with.

    A stream takes its settings over when it starts; the session is left as it was.
    """
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, DEFAULTS[STATE_STORE])
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own: there the
    driver is the sole executor. On a cluster an unset folder is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_folders[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
