"""WARC archives as a Spark data source.

``spark.read.format("warc").load(folder)`` plans one partition per archive file. Filters on the record type, the
target URI, the record id, the digest and the other header columns are pushed into the reader: a record's headers
are parsed first, and where they fail a filter the payload is skipped, neither inflated nor decoded. ``df.write
.format("warc").mode("append").save(folder)`` writes records of type response (HTTP head and payload) and revisit
(HTTP head only, naming the record it repeats).

Files are gzip members, one record each. A member carries its own length in the gzip extra field ``SL`` (compressed
and plain bytes, as crawlers write it), so the reader jumps over unwanted ones; members without it and plain files
are read through. Tasks write files under names no other attempt uses, at most ``fileBytes`` each; the commit lists
them in ``_files-*.json``, and only listed files are read. A folder without such lists is read as all its
``.warc`` and ``.warc.gz`` files.

Rules: a null header value leaves the header out and reads back as null; control characters in header values are
written as ``%XX``; a null payload is an empty one; the payload column of revisits is null. An empty table writes no
file and reads as no rows. Columns are taken by name and others ignored. Spark plans all scans of one loaded
DataFrame with the filters of the last: a plan that reads an archive twice calls ``read_archive`` twice.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull,
    IsNull, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage,
)

from jobscape.session import scratch_path

# Column and header, in the order headers are written. Fixed values.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "record_date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "payload_bytes": "X-Payload-Length",
}
COLUMNS = {h.lower(): c for c, h in HEADERS.items()}
SCHEMA = ", ".join(f"{c} {'long' if c == 'payload_bytes' else 'string'}" for c in HEADERS) + ", payload binary"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PUSHABLE = (EqualTo, EqualNullSafe, In, IsNull, IsNotNull, StringStartsWith, StringEndsWith, StringContains)
BATCH_BYTES = 4 << 20


def _holds(f: Filter, value) -> bool:
    if isinstance(f, IsNull):
        return value is None
    if isinstance(f, EqualNullSafe):
        return value == f.value
    if value is None:
        return False
    if isinstance(f, IsNotNull):
        return True
    if isinstance(f, EqualTo):
        return value == f.value
    if isinstance(f, In):
        return value in f.value
    if isinstance(f, StringStartsWith):
        return value.startswith(f.value)
    return value.endswith(f.value) if isinstance(f, StringEndsWith) else f.value in value


def _member(record: bytes) -> bytes:
    """One record as a gzip member that carries its own length."""
    pack = zlib.compressobj(6, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = pack.compress(record) + pack.flush()
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff"
    whole = len(head) + 22 + len(body) + 8
    extra = struct.pack("<H2sHQQ", 20, b"SL", 16, whole, len(record))
    return head + extra + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _record(row: dict) -> bytes:
    payload = row.get("payload") or b""
    payload = payload.encode() if isinstance(payload, str) else payload
    revisit = row.get("record_type") == "revisit"
    length = row.get("payload_bytes")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload) if length is None else length}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1"]
    for column, header in HEADERS.items():
        if (value := row.get(column)) is not None:
            lines.append(f"{header}: " + re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", str(value)))
    if revisit:
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


class _Records:
    """Records of one file: headers first, blocks on demand."""

    def __init__(self, file: pa.NativeFile, packed: bool):
        self.file, self.packed, self.left = file, packed, b""

    def _more(self, n: int = 1 << 20) -> bool:
        data = self.file.read(n)
        self.left += data
        return bool(data)

    def _need(self, n: int) -> bool:
        while len(self.left) < n:
            if not self._more(max(1 << 20, n - len(self.left))):
                return False
        return True

    def __iter__(self) -> Iterator[tuple[dict[str, str], object]]:
        return self._members() if self.packed else self._plain()

    def _skip(self, n: int) -> None:
        if n <= len(self.left):
            self.left = self.left[n:]
        else:
            self.file.seek(self.file.tell() + n - len(self.left))
            self.left = b""

    def _members(self) -> Iterator[tuple[dict[str, str], object]]:
        while self._need(18):
            if self.left[3] & 4 and self._need(32) and self.left[12:14] == b"SL":
                whole, _ = struct.unpack_from("<QQ", self.left, 16)
                self._need(min(whole, 4096))
                opened = zlib.decompressobj(zlib.MAX_WBITS | 16)
                start = opened.decompress(self.left[:whole], 4096)
                while b"\r\n\r\n" not in start and opened.unconsumed_tail:
                    start += opened.decompress(opened.unconsumed_tail, 4096)
                if b"\r\n\r\n" not in start:  # headers longer than what was read
                    self._need(whole)
                    start = zlib.decompress(self.left[:whole], zlib.MAX_WBITS | 16)
                head, _, _ = start.partition(b"\r\n\r\n")

                def block(whole=whole, at=len(head) + 4):
                    self._need(whole)
                    return zlib.decompress(self.left[:whole], zlib.MAX_WBITS | 16)[at:]

                yield _parsed(head), block
                self._skip(whole)
            else:
                opened, data = zlib.decompressobj(zlib.MAX_WBITS | 16), b""
                while not opened.eof:
                    data += opened.decompress(self.left)
                    self.left = opened.unused_data
                    if not opened.eof and not self._more():
                        raise ValueError("truncated archive")
                head, _, rest = data.partition(b"\r\n\r\n")
                yield _parsed(head), lambda rest=rest: rest

    def _plain(self) -> Iterator[tuple[dict[str, str], object]]:
        while True:
            self.left = self.left.lstrip(b"\r\n")
            while (end := self.left.find(b"\r\n\r\n")) < 0:
                if not self._more():
                    return
                self.left = self.left.lstrip(b"\r\n")
            fields = _parsed(self.left[:end])
            size = int(fields.get("content-length", 0))

            def block(at=end + 4, size=size):
                self._need(at + size)
                return self.left[at : at + size]

            yield fields, block
            self._skip(end + 4 + size)


def _parsed(head: bytes) -> dict[str, str]:
    lines = re.sub(r"\r\n[ \t]+", " ", head.decode("utf-8", "replace")).split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


class _Reader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder, self.filters = folder, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        self.filters = []  # the plan before may have been of another query
        for f in filters:
            if isinstance(f, PUSHABLE) and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        store, root = fs.FileSystem.from_uri(self.folder)
        names = sorted(i.base_name for i in store.get_file_info(fs.FileSelector(root, allow_not_found=True)) if i.is_file)
        lists = [n for n in names if n.startswith("_files-")]
        if lists:
            names = sorted({f for n in lists for f in json.loads(store.open_input_stream(f"{root}/{n}").read())})
        return [InputPartition(n) for n in names if n.endswith((".warc", ".warc.gz"))]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition is None or partition.value is None:
            return
        store, root = fs.FileSystem.from_uri(self.folder)
        rows, size = [], 0
        with store.open_input_file(f"{root}/{partition.value}") as file:
            for fields, block in _Records(file, partition.value.endswith(".gz")):
                row = {c: fields.get(h) for h, c in COLUMNS.items()}
                row["payload_bytes"] = int(row["payload_bytes"]) if row["payload_bytes"] else None
                if not all(_holds(f, row[f.attribute[0]]) for f in self.filters):
                    continue
                row["payload"] = None
                if row["record_type"] == "response":
                    row["payload"] = block().partition(b"\r\n\r\n")[2][: -4 if partition.value.endswith(".gz") else None]
                elif row["record_type"] != "revisit":
                    row["payload"] = block()[: int(fields.get("content-length", 0))]
                rows.append(row)
                size += 300 + len(row["payload"] or b"")
                if size > BATCH_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [(c, pa.int64() if c == "payload_bytes" else pa.string()) for c in HEADERS] + [("payload", pa.binary())]
    return pa.RecordBatch.from_pylist(rows, pa.schema(kinds))


class _Written(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files


class _Writer(DataSourceArrowWriter):
    def __init__(self, folder: str, file_bytes: int):
        self.folder, self.file_bytes = folder, file_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = fs.FileSystem.from_uri(self.folder)
        store.create_dir(root, recursive=True)
        files, out = [], None
        for batch in iterator:
            wanted = [n for n in batch.schema.names if n in HEADERS or n == "payload"]
            for start in range(0, batch.num_rows, 256):
                for row in batch.select(wanted).slice(start, 256).to_pylist():
                    if out is None:
                        files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out = store.open_output_stream(f"{root}/{files[-1]}", compression=None)
                    out.write(_member(_record(row)))
                    if out.tell() > self.file_bytes:
                        out.close()
                        out = None
        if out is not None:
            out.close()
        return _Written(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = fs.FileSystem.from_uri(self.folder)
        store.create_dir(root, recursive=True)
        files = sorted(f for m in messages if m is not None for f in m.files)
        with store.open_output_stream(f"{root}/_files-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(files).encode())


class WarcSource(DataSource):
    """Options: ``path``, and for writing ``fileBytes`` (64 MB)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> _Writer:
        if overwrite:
            raise ValueError("archives are appended to; choose a new folder instead of overwriting one")
        return _Writer(self.options["path"], int(self.options.get("fileBytes", 64 << 20)))


def register(spark: SparkSession) -> None:
    """Makes the source known, and lets Spark hand filters to Python sources."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("warc").load(folder)


def page_records(pages: DataFrame, date: str, least: int = 100) -> DataFrame:
    """A record per page: of equal payloads of at least ``least`` bytes the smallest page_id is the response.

    Rows without page_id repeat the response of their payload, where there is one; rows that repeat a page_id are
    alike. The first of each payload is found over digests alone, counted on the map side; payloads that occur once
    take no part in the join that follows, and adaptive execution splits the one of a frequent payload.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"payload_digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})
    spark = pages.sparkSession
    path = scratch_path(spark, "first-payloads")
    rows.filter(F.col("payload_bytes") >= least).groupBy(F.col("payload_digest").alias("digest")).agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")
    ).filter("n > 1 and first is not null").select("digest", "first").write.parquet(path)
    firsts = spark.read.parquet(path)
    repeats = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    return rows.join(firsts, F.col("payload_digest") == F.col("digest"), "left").select(
        F.when(repeats, "revisit").otherwise("response").alias("record_type"),
        urn("page_id").alias("record_id"),
        "target_uri",
        F.lit(date).alias("record_date"),
        F.concat(F.lit("sha256:"), "payload_digest").alias("payload_digest"),
        F.when(repeats, urn("first")).alias("refers_to"),
        "payload_bytes",
        F.when(~repeats, F.col("payload")).alias("payload"),
    )


def page_of(column: str):
    """The page id in a record id of ``page_records``."""
    return F.regexp_extract(column, r"<urn:page:(-?\d+)>", 1).try_cast("long")
