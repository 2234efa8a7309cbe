from __future__ import annotations

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from jobscape.llm import warc
from jobscape.session import scratch_path

DATE = "2026-01-01T00:00:00Z"
SCHEMA = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def archive(spark):
    warc.register(spark)
    long = "é" * 200
    rows = [
        (5, "http://a/5", long), (2, "http://a/2", long), (9, None, long), (3, "http://b/3\r\nX: y", "short"), (4, "http://b/4", "short"),
        (6, "http://b/6", None), (7, "http://b/7", ""), (None, "http://b/none", long), (8, "http://c/8", "z" * 3_000_000), (1, "http://c/1", "\r\n\r\nWARC/1.0\r\n" * 20),
    ]
    pages = spark.createDataFrame(rows, SCHEMA).withColumn("first", F.lit("x")).withColumn("digest", F.lit("x"))
    folder = scratch_path(spark, "test-warc")
    warc.page_records(pages, DATE).write.format("warc").mode("append").option("fileBytes", 2000).save(folder)
    return folder, {r[0]: (r[2] or "").encode() for r in rows}


def test_round_trip(spark, archive):
    folder, payloads = archive
    got = {r.page_id: r for r in warc.read_archive(spark, folder).withColumn("page_id", warc.page_of("record_id")).collect()}
    assert set(got) == set(payloads)
    for page, payload in payloads.items():
        r = got[page]
        repeats = page in (5, 9, None)
        assert r.record_type == ("revisit" if repeats else "response")
        assert r.refers_to == ("<urn:page:2>" if repeats else None)
        assert (r.payload_bytes, r.payload_digest) == (len(payload), "sha256:" + hashlib.sha256(payload).hexdigest())
        assert r.payload == (None if repeats else payload)
    assert got[9].target_uri is None and got[3].target_uri == "http://b/3%0D%0AX: y"


def test_filters_reach_the_reader(spark, archive, monkeypatch):
    folder, _ = archive
    reader = warc._Reader(folder if "://" in folder else f"file://{folder}")
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("payload",), b"x")]))
    assert left == [warc.EqualTo(("payload",), b"x")]
    monkeypatch.setattr(warc.zlib, "decompress", lambda *a: pytest.fail("a payload was inflated"))
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert sorted(r["record_id"] for r in rows) == ["<urn:page:5>", "<urn:page:9>", "<urn:page:>"]


@pytest.mark.parametrize(
    "condition",
    ["target_uri like 'http://b/%'", "target_uri is null", "refers_to is not null", "record_id in ('<urn:page:1>', '<urn:page:5>')", "payload_bytes = 5", "target_uri like '%/8'", "record_type <=> 'revisit'"],
)
def test_filters_change_no_result(spark, archive, condition):
    folder, _ = archive
    all_rows = warc.read_archive(spark, folder).collect()
    whole = spark.createDataFrame(all_rows, warc.SCHEMA).filter(condition).select("record_id").collect()
    assert sorted(warc.read_archive(spark, folder).filter(condition).select("record_id").collect()) == sorted(whole) != []


def test_plain_and_foreign_archives(spark, tmp_path):
    warc.register(spark)
    rows = [{"record_type": "response", "record_id": f"<urn:page:{i}>", "payload": b"p" * i * 1000, "payload_bytes": i * 1000} for i in range(5)]
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(info + b"".join(map(warc._record, rows)))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(warc._record(r)) for r in rows))
    (tmp_path / "notes.txt").write_text("no archive")
    got = warc.read_archive(spark, f"file://{tmp_path}").collect()
    assert sorted((r.record_id, bytes(r.payload)) for r in got if r.record_id) == sorted((r["record_id"], r["payload"]) for r in rows * 2)
    assert [bytes(r.payload) for r in got if r.record_type == "warcinfo"] == [b"abcd"]


def test_no_pages(spark):
    warc.register(spark)
    folder = scratch_path(spark, "test-warc")
    warc.page_records(spark.createDataFrame([], SCHEMA), DATE).write.format("warc").mode("append").save(folder)
    assert warc.read_archive(spark, folder).count() == 0
