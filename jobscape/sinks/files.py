"""File outputs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def write_ndjson(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line; nulls are written, text stays as it is."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_json_list(df: DataFrame, path: str) -> None:
    """Reference lists: every part file is one indented JSON list of the rows of one partition.

    A table of one partition gives one file. Rows pass between the brackets one by one, so a list may be of any size;
    partitions without rows give no file content.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = "[\n"
        for batch in batches:
            lines = []
            for text in batch.column(0).to_pylist():
                lines.append(mark + text)
                mark = ","
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        if mark == ",":
            yield pa.RecordBatch.from_arrays([pa.array(["]"])], names=["value"])

    options = {"pretty": "true", "ignoreNullFields": "false"}
    rows = df.select(F.to_json(F.struct("*"), options).alias("value"))
    rows.mapInArrow(run, "value string").write.mode("errorifexists").text(path)


def write_csv_report(df: DataFrame, path: str, sep: str = ",") -> None:
    """A report as CSV with header, in UTF-8."""
    df.write.mode("errorifexists").option("header", True).option("sep", sep).option("encoding", "UTF-8").csv(path)
