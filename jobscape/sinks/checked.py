"""Loads that check their rows while they write them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, functions as F

from jobscape.operators.quality import check_unique
from jobscape.schemas import required_columns

OK = "_ok"


@dataclass
class Load:
    """What was written: ``rows`` that broke no rule, ``failing`` ones with the names of the rules, and the counts."""

    rows: DataFrame
    failing: DataFrame
    counts: dict[str, int]
    order: tuple[str, ...]

    def report(self) -> DataFrame:
        """(check, n_rows): rows read, rows that failed, and how many broke each rule."""
        return self.rows.sparkSession.createDataFrame([(c, self.counts[c]) for c in self.order], "check string, n_rows bigint")

    def repeated(self, keys: str | Sequence[str]) -> DataFrame:
        """Keys that several written rows share. Only the keys of the written table are read, not the input again."""
        names = [keys] if isinstance(keys, str) else list(keys)
        return check_unique(self.rows.select(*names).unionByName(self.failing.select(*names)), names)


def load_checked(
    df: DataFrame,
    path: str,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[Any]] | None = None,
    rules: Mapping[str, Column] | None = None,
    layout: Any = None,
) -> Load:
    """Writes ``df`` to an unused folder and checks it in the same pass over the input.

    A row fails where a ``not_null`` column (or one the ``layout`` requires) is null, a value is outside the
    ``accepted`` ones (nulls aside), or a predicate of ``rules`` holds. Failing rows go to a side table with the names
    of the rules they broke, the others to the main one; the counts are observed by the write.
    """
    required = [c for c in required_columns(layout) if c not in not_null] if layout is not None else []
    tests = {f"not_null:{c}": F.col(c).isNull() for c in [*not_null, *required]}
    tests |= {f"accepted:{c}": ~F.col(c).isin(list(values)) for c, values in (accepted or {}).items()}
    tests |= dict(rules or {})
    broken = F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in tests.items()))) if tests else F.array().cast("array<string>")
    marked = df.withColumn("broken", broken).withColumn(OK, F.size("broken") == 0)
    seen = Observation()
    counts = {"rows": F.count(F.lit(1)), "failing": F.count(F.when(~F.col(OK), 1))}
    counts |= {name: F.count(F.when(test, 1)) for name, test in tests.items()}
    # Metrics are told apart by their place: a rule may have any name.
    observed = marked.observe(seen, *(c.alias(f"m{i}") for i, c in enumerate(counts.values())))
    observed.write.mode("errorifexists").partitionBy(OK).parquet(path)
    found = seen.get
    stored = df.sparkSession.read.schema(f"{_ddl(marked)}").parquet(path)
    return Load(
        stored.filter(F.col(OK)).drop("broken", OK), stored.filter(~F.col(OK)).drop(OK),
        {name: int(found[f"m{i}"]) for i, name in enumerate(counts)}, tuple(counts),
    )


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
