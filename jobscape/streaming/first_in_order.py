"""The first fetch per key in search order, whatever the order of arrival."""

from __future__ import annotations

import pickle
import re
import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Milliseconds of the units of a delay.
UNITS = {"second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}


def milliseconds(delay: str) -> int:
    """``"2 hours"`` and the like."""
    found = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day)s?\s*", delay)
    if not found:
        raise ValueError(f"a delay reads like '2 hours', not {delay!r}")
    return int(found.group(1)) * UNITS[found.group(2)]


class FirstInOrder:
    """One row and the time it is due per key of a bucket: the row that is first in order so far, given out when it is due.

    Rows come with the text that names their key in ``key`` and the time they are due in ``due``.
    """

    def __init__(self, columns: Sequence[str], whole: set[str], order: Sequence[str], key: str, due: str):
        self.columns, self.whole, self.key, self.due = list(columns), whole, key, due
        self.order = [self.columns.index(c) for c in order]

    def _rank(self, row: Sequence) -> tuple:
        return tuple((row[i] is not None, row[i]) for i in self.order)  # missing places come first, as in a sort

    def _add(self, part: pd.DataFrame, held: dict[str, tuple[tuple, int]], fresh: dict[str, int]) -> None:
        """Put the rows of ``part`` among those held. The first batch of a key says when it is due: ``fresh`` has its keys."""
        rows = zip(*([_plain(v, c in self.whole) for v in part[c].tolist()] for c in self.columns))
        for key, due, row in zip(part[self.key].tolist(), part[self.due].tolist(), rows):
            best, first = held.get(key, (None, None))
            if best is None:
                first = fresh[key] = int(due)
            elif due < fresh.get(key, due):
                first = fresh[key] = int(due)
            if best is None or self._rank(row) < self._rank(best):
                held[key] = row, first
            elif first != held[key][1]:
                held[key] = best, first

    def __call__(self, bucket, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = pickle.loads(bytes(state.get[0])) if state.exists else {}
        if not state.hasTimedOut:
            fresh: dict[str, int] = {}
            for part in parts:
                self._add(part, held, fresh)
        now = state.getCurrentWatermarkMs()
        answered = [row for row, due in held.values() if due <= now]
        held = {key: (row, due) for key, (row, due) in held.items() if due > now}
        if held:
            due = min(due for _, due in held.values())
            state.update((pickle.dumps(held), due))
            # A timeout comes when the watermark is past it, a row is due when the watermark reaches it.
            state.setTimeoutTimestamp(max(due - 1, now + 1))
        elif state.exists:
            state.remove()
        if answered:
            yield pd.DataFrame(answered, columns=self.columns, dtype=object)


def _plain(value, whole: bool):
    """A value of a pandas row as Python has it; whole numbers come as text, which pandas leaves as it is where others are missing."""
    if value is None or value is pd.NaT or (isinstance(value, float) and pd.isna(value)):
        return None
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    value = value.item() if hasattr(value, "item") else value
    return int(value) if whole else value


def _name(key: str, kind: T.DataType) -> Column:
    """A key column whose JSON is one for the values that a grouping takes as equal, and differs for all others."""
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return (F.col(key) + F.lit(0.0)).cast("string")  # no minus zero
    return F.unix_micros(key) if isinstance(kind, T.TimestampType) else F.col(key)


def first_in_order_stream(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str, delay: str, buckets: int = 256
) -> DataFrame:
    """Per key the row that comes first in ``order``, among copies whose ``ts`` lie at most ``delay`` apart.

    A key is answered once the watermark, ``delay`` behind the newest row, has passed its earliest row by ``delay``;
    then it leaves the state, which so holds the keys of the last two delays at most: one row and one time each,
    whatever the number of copies. Keys are dealt to ``buckets``, each of which has one value and one timeout in the
    state and one call of Python in a batch: a call costs as much as hundreds of rows. A bucket's keys are in memory
    together; ``buckets`` and the columns must stay as they are while a checkpoint is used. Where the state may outgrow
    memory, the stream wants the RocksDB store: ``build_session`` sets it, and in any other session ``package_state_store``.
    """
    kinds = {f.name: f.dataType for f in stream.schema}
    schema = ", ".join(f"`{name}` {kind.simpleString()}" for name, kind in kinds.items())
    whole = {name for name, kind in kinds.items() if isinstance(kind, T.IntegralType)}
    processor = FirstInOrder(stream.columns, whole, order, "_key", "_due")
    names = F.struct(*(_name(k, kinds[k]).alias(f"k{i}") for i, k in enumerate(keys)))
    return (
        stream.withWatermark(ts, delay)
        .select(
            *(F.col(f"`{c}`").cast("string").alias(c) if c in whole else F.col(f"`{c}`") for c in stream.columns),
            F.to_json(names).alias("_key"),
            (F.unix_millis(F.col(ts).cast("timestamp")) + milliseconds(delay)).alias("_due"),
        )
        .withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(buckets)))
        .groupBy("_bucket")
        .applyInPandasWithState(processor, schema, "best binary, due bigint", "append", GroupStateTimeout.EventTimeTimeout)
    )
