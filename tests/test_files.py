from __future__ import annotations

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from jobscape import schemas
from jobscape.sinks.files import write_json_list
from jobscape.sources import files, json_lists
from jobscape.sources.paged import read_pages_of, read_searches, stream_searches

# Fetches run in the tasks, which do not know this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture
def folder(tmp_path):
    def write(**named):
        for name, content in named.items():
            stem, _, suffix = name.rpartition("__")
            (tmp_path / f"{stem}.{suffix}").write_text(content, encoding="utf-8")
        return str(tmp_path)

    return write


def lines(*records):
    return "\n".join(r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in records)


def test_read_ndjson_ignores_unknown_keys_blank_lines_and_done(spark, folder, tmp_path, rows):
    path = folder(a__ndjson=lines({"nom": "Rhône", "code": "69", "type": "x"}, "", {"code": "84"}))
    (tmp_path / "done").mkdir()
    (tmp_path / "done" / "b.ndjson").write_text(lines({"code": "1"}))
    assert rows(files.read_ndjson(spark, f"{path}/*.ndjson", schemas.REGIONS)) == sorted([("Rhône", "69"), (None, "84")], key=repr)


def test_read_ndjson_fails_on_a_cut_line(spark, folder):
    path = folder(a__ndjson=lines({"code": "1"}, '{"code": "2'))
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_ndjson(spark, path, schemas.REGIONS).collect()


@pytest.mark.parametrize("line", ['{"code": "2', '[{"code": "1"}]', "3", '{"code": "1", "n": "x"}'])
def test_checked_read_names_file_and_line(spark, folder, line):
    path = folder(a__ndjson=lines({"code": "1"}, line))
    with pytest.raises(Exception, match="malformed line in a.ndjson: "):
        files.read_ndjson_checked(spark, path, "code string, n int").collect()


@pytest.mark.parametrize(
    "record, key",
    [({"id": "1", "type": "EPCI"}, "type"), ({"id": "1", "place": {"name": "x", "zone": 1}}, "place.zone"), ({"id": "1", "tags": [{"code": "a"}, {"label": "b"}]}, "tags\\[\\].label")],
)
def test_strict_read_rejects_unknown_keys_at_every_depth(spark, folder, record, key):
    path = folder(a__ndjson=lines({"id": "0"}, record))
    layout = "id string, place struct<name string>, tags array<struct<code string>>"
    with pytest.raises(Exception, match=f"unknown keys in a.ndjson: {key}"):
        files.read_ndjson(spark, path, layout, unknown="reject").collect()


def test_strict_read_accepts_known_keys(spark, folder, rows):
    path = folder(a__ndjson=lines({"nom": "x", "code": "1"}, {"code": "2"}))
    assert rows(files.read_ndjson(spark, path, schemas.REGIONS, unknown="reject")) == sorted([("x", "1"), (None, "2")], key=repr)


def test_split_read_returns_rejects(spark, folder, rows):
    path = folder(a__ndjson=lines({"code": "1"}, '{"code": "2', "[1]", "3", "", {"code": "4"}))
    good, bad = files.read_ndjson_split(spark, path, schemas.REGIONS)
    assert rows(good.select("code")) == [("1",), ("4",)]
    assert rows(bad) == [("a.ndjson", "3"), ("a.ndjson", "[1]"), ("a.ndjson", '{"code": "2')]


def test_bad_lines_are_told_by_file_and_number(spark, folder, rows):
    good = [json.dumps({"code": str(i), "nom": "x" * (i % 50)}) for i in range(400)]
    a = [*good[:7], "", "[1]", *good[7:300], '{"code": ', "  ", *good[300:], "7"]
    path = folder(a__ndjson="\n".join(a) + "\n", b__ndjson="\n".join([*good, "{"]), c__ndjson="\n".join(good))
    want = sorted([("a.ndjson", a.index("[1]") + 1, "[1]"), ("a.ndjson", a.index('{"code": ') + 1, '{"code":'), ("a.ndjson", len(a), "7"), ("b.ndjson", 401, "{")], key=repr)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("128m", "3000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            assert rows(files.bad_lines(spark, path, schemas.REGIONS)) == want
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    with pytest.raises(ValueError, match=r"a\.ndjson:9: \[1\]"):
        files.read_ndjson_checked(spark, path, schemas.REGIONS, before=True)
    assert files.read_ndjson_checked(spark, f"{path}/c.ndjson", schemas.REGIONS, before=True).count() == 400


def test_json_list(spark, folder, rows):
    path = folder(a__json='\n [{"a": 1, "b": 2}, {"b": 3, "c": 4}]')
    assert rows(files.read_json_list(spark, path, "a int, b int, c int")) == sorted([(1, 2, None), (None, 3, 4)], key=repr)


def awkward_items(n):
    import random

    rng = random.Random(n)
    texts = ["}", "{", '"', "\\", "]", "[", "é", "日本", "\\\\\"", "a,b", "", "\n", '{"x": 1}']
    word = lambda: "".join(rng.choice(texts) for _ in range(rng.randint(0, 6)))
    return [{"id": i, word(): word(), "l": [{"m": [word()]}, [], word()], "o": {"p": {}}} for i in range(n)]


@pytest.mark.parametrize(("block", "indent"), [(7, None), (100, 2), (997, None), (1 << 20, 2)])
def test_lists_in_blocks_give_the_same_objects(spark, folder, block, indent):
    items = awkward_items(4 if block == 7 else 60)
    dumped = lambda v: json.dumps(v, ensure_ascii=False, indent=indent)
    wrapped = {"a": [{"id": -1}], "resultats\\\"": [{"id": -2}], "b": {"resultats": [{"id": -3}]}, "resultats": [3, "x}", [{"id": -4}], None, *items], "z": [{"id": -5}]}
    path = folder(l__json=dumped(items), w__json=dumped(wrapped), e__json="[]", n__json=dumped({"resultats": []}))
    found = files.read_wrapped(spark, path, "*.json", block_bytes=block)
    got = found.orderBy("source_file", "block_start", "line_in_task").collect()
    assert [json.loads(r["raw_json"]) for r in got] == [*items, *items]
    assert {r["source_file"] for r in got} == {"l.json", "w.json"}
    strict = json_lists.read_json_items(spark, path, "[le].json", block_bytes=block)
    assert sorted(json.loads(r["raw_json"])["id"] for r in strict.collect()) == list(range(len(items)))
    assert found.rdd.getNumPartitions() > len(dumped(wrapped).encode()) // block


@pytest.mark.parametrize("content", ['[{"a": 1}, 3]', '["x"]', "[[]]", '[{"a": 1}, "{", {"a": 2}]', "[{"])
@pytest.mark.parametrize("block", [3, 1000])
def test_lists_of_other_things_are_refused(spark, folder, content, block):
    with pytest.raises(Exception, match="must hold a list|ends inside"):
        files.read_json_list(spark, folder(a__json=content), "a int", block_bytes=block).collect()


def test_lists_are_written_row_by_row(spark, tmp_path):
    path = str(tmp_path / "lists")
    write_json_list(spark.range(50).select("id", F.lit(None).cast("string").alias("no")).repartition(3), path)
    parts = [p.read_text() for p in (tmp_path / "lists").glob("part-*.txt") if p.stat().st_size]
    assert len(parts) == 3 and sorted(r["id"] for p in parts for r in json.loads(p)) == list(range(50))
    assert all(list(r) == ["id", "no"] for p in parts for r in json.loads(p))
    assert files.read_json_list(spark, path, "id bigint", block_bytes=100).count() == 50


def test_json_list_refuses_an_object(spark, folder):
    with pytest.raises(Exception, match="must hold a list"):
        files.read_json_list(spark, folder(a__json='{"a": 1}'), "a int").collect()


def test_json_list_missing_file(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_json_list(spark, str(tmp_path / "none.json"), "a int").collect()


def test_read_offers_any(spark, folder, rows):
    path = folder(
        offres_1__ndjson=lines({"id": "a"}, {"id": "b"}),
        offres_2__json='{"metadata": {}, "resultats": [{"id": "c"}, 5, "x", {"id": "d", "n": 1.0}]}',
        offres_3__json='[{"id": "e"}, null]',
        other__json="[]",
    )
    raw = files.read_offers_any(spark, path)
    got = files.raw_with_lineage(raw.orderBy(*files.READING_ORDER))
    assert [(r["offer_id"], r["source_file"].removeprefix("offres_")) for r in got.collect()] == [
        ("a", "1.ndjson"), ("b", "1.ndjson"), ("c", "2.json"), ("d", "2.json"), ("e", "3.json"),
    ]
    assert rows(files.parse_records(raw, "id string, n double").filter("n is not null")) == [("d", 1.0)]


@pytest.mark.parametrize("content", ['{"metadata": {}}', '{"resultats": {"id": 1}}', "3"])
def test_other_shapes_fail(spark, folder, content):
    path = folder(offres_1__json=content)
    with pytest.raises(Exception, match="expected a list or an object"):
        files.read_offers_any(spark, path).collect()


def test_payload_is_kept_as_it_stands(spark, folder):
    line = '{"id": "é", "b": 1, "a": [1, 2.50]}'
    assert files.raw_lines(spark, folder(a__ndjson=line)).first()["raw_json"] == line


def test_latest_file(spark, folder):
    path = folder(offres_20260406__json="[]", offres_20260408__json="[]", zz__json="[]")
    assert files.latest_file(spark, path, "offres_*.json").endswith("20260408.json")
    with pytest.raises(FileNotFoundError):
        files.latest_file(spark, path, "nothing_*")


def test_latest_file_goes_by_name_not_by_folder(spark, tmp_path):
    for name in ("b/offres_1.json", "a/offres_2.json"):
        (tmp_path / name).parent.mkdir()
        (tmp_path / name).write_text("[]")
    assert files.latest_file(spark, f"{tmp_path}/*", "offres_*.json").endswith("a/offres_2.json")


def test_reading_order_across_blocks(spark, folder):
    """A file read in several blocks still yields its lines in file order."""
    path = folder(a__ndjson=lines(*[{"id": i} for i in range(3000)]), b__ndjson=lines({"id": 3000}))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        raw = files.raw_lines(spark, path)
        ids = [int(r[0]) for r in files.raw_with_lineage(raw.orderBy(*files.READING_ORDER)).select("offer_id").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert raw.rdd.getNumPartitions() > 1
    assert ids == list(range(3001))


def test_referentials(spark, folder, rows):
    path = folder(
        ref_permis__json='[{"code": "B", "libelle": "Voiture"}, {"code": "B", "libelle": null, "x": {"a": 1}, "y": [1]}, 7]',
        ref_langues__json='[{"libelle": "Anglais", "n": 3}]',
        ref_broken__json='{"code": "Z"}',
    )
    assert rows(files.read_referentials(spark, path)) == [
        ("ref_langues", "libelle", "Anglais"), ("ref_langues", "n", "3"),
        ("ref_permis", "code", "B"), ("ref_permis", "libelle", "Voiture"),
    ]
    raw = files.raw_referentials(spark, path, "run-1")
    assert raw.filter("code = 'B'").count() == 2 and raw.filter("run_id = 'run-1'").count() == 3


def test_schema_from_spec():
    spec = """[{"name": "id", "type": "STRING", "mode": "REQUIRED"}, {"name": "n", "type": "INTEGER"},
      {"name": "codes", "type": "STRING", "mode": "REPEATED"},
      {"name": "place", "type": "RECORD", "mode": "NULLABLE", "fields": [{"name": "lat", "type": "FLOAT"},
        {"name": "tags", "type": "RECORD", "mode": "REPEATED", "fields": [{"name": "ok", "type": "BOOL"}]}]},
      {"name": "at", "type": "TIMESTAMP"}]"""
    got = schemas.schema_from_spec(spec)
    assert got.simpleString() == (
        "struct<id:string,n:bigint,codes:array<string>,place:struct<lat:double,tags:array<struct<ok:boolean>>>,at:timestamp>"
    )
    assert schemas.required_columns(got) == ["id"]
    with pytest.raises(ValueError, match="unknown type"):
        schemas.schema_from_spec([{"name": "x", "type": "GEOGRAPHY"}])


def test_layouts(spark):
    assert len(schemas.struct_of(schemas.CODED_OFFERS).fields) == 43
    assert len(schemas.struct_of(schemas.NAMED_OFFERS).fields) == 16
    assert schemas.required_columns(schemas.CODED_OFFERS) == ["id"]


def test_paged_source(spark, tmp_path, rows):
    """Pages come from files; the fetch runs in the tasks."""
    for search, page, ids in [("s1", 1, "ab"), ("s1", 2, "c"), ("s2", 1, "bd")]:
        (tmp_path / f"{search}-{page}.json").write_text(json.dumps([{"id": i} for i in ids]))
    base = str(tmp_path)

    def fetch(request):
        with open(f"{base}/{request['file']}", encoding="utf-8") as page:
            return json.load(page)

    requests = [(s, p, {"file": f"{s}-{p}.json"}) for s, p in [("s1", 1), ("s1", 2), ("s2", 1)]]
    got = read_pages_of(spark, requests, fetch)
    from jobscape.operators.dedupe import keep_first

    first = keep_first(files.raw_with_lineage(got.withColumnRenamed("search", "source_file")).withColumn("x", got_order()), "offer_id", ["x"])
    assert got.rdd.getNumPartitions() == 3
    assert rows(got.selectExpr("search_no", "page", "pos", "get_json_object(raw_json, '$.id')")) == [
        (0, 1, 0, "a"), (0, 1, 1, "b"), (0, 2, 0, "c"), (1, 1, 0, "b"), (1, 1, 1, "d"),
    ]
    assert first.count() == 4


class CountedService:
    """Pages of ids in a folder; every call leaves a file, as tasks share no memory. It tells wrong totals."""

    def __init__(self, base, sizes, page_size):
        self.base, self.sizes, self.page_size = base, sizes, page_size

    def __call__(self, request, page):
        import uuid

        search = request["search"]
        open(f"{self.base}/call-{search}-{page}-{uuid.uuid4().hex}", "w").close()
        first = (page - 1) * self.page_size
        return [{"id": f"{search}{i}", "total": 7} for i in range(first, min(first + self.page_size, self.sizes[search]))]

    def calls(self):
        import os

        return sorted(tuple(n.split("-")[1:3]) for n in os.listdir(self.base) if n.startswith("call-"))


SIZES = {"none": 0, "short": 2, "full": 6, "long": 20}


@pytest.mark.parametrize(("most", "pages", "found"), [(None, {"none": 1, "short": 1, "full": 3, "long": 7}, 28), (7, {"none": 1, "short": 1, "full": 3, "long": 3}, 15), (6, {"none": 1, "short": 1, "full": 2, "long": 2}, 14)])
def test_searches_are_read_until_a_short_page(spark, tmp_path, most, pages, found):
    service = CountedService(str(tmp_path), SIZES, 3)
    got = read_searches(spark, [(s, {"search": s}) for s in SIZES], service, 3, most)
    assert got.rdd.getNumPartitions() == len(SIZES)
    # Sorted here: an order in Spark would read the source once more to find its ranges.
    ids = [json.loads(r["raw_json"])["id"] for r in sorted(got.collect(), key=lambda r: (r["search_no"], r["page"], r["pos"]))]
    assert ids == [f"{s}{i}" for s, n in SIZES.items() for i in range(min(n, most or n))] and len(ids) == found
    assert service.calls() == sorted((s, str(p)) for s, n in pages.items() for p in range(1, n + 1))


def test_small_blocks_share_tasks(spark, folder, monkeypatch):
    from jobscape.sources import json_lists

    monkeypatch.setattr(json_lists, "MOST_TASKS", 4)
    items = [{"id": n, "t": "]}" * (n % 9)} for n in range(50)]
    path = folder(l__json=json.dumps({"resultats": items}))
    found = files.read_wrapped(spark, path, "*.json", block_bytes=32)
    assert found.rdd.getNumPartitions() <= 4
    got = sorted(found.collect(), key=lambda r: (r["block_start"], r["line_in_task"]))
    assert [json.loads(r["raw_json"]) for r in got] == items


def test_a_stream_of_searches_goes_on_where_it_stopped(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    service = CountedService(str(tmp_path / "calls"), SIZES, 3)
    progress, target, checkpoint = (str(tmp_path / n) for n in ("progress", "target", "checkpoint"))

    def started():
        stream = stream_searches(spark, [(s, {"search": s}) for s in SIZES], service, 3, progress, pages_per_round=2)
        return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).start(target)

    query = started()
    while not query.recentProgress:
        query.processAllAvailable()
    query.stop()
    for _ in range(2):
        query = started()
        query.processAllAvailable()
        query.stop()
    got = spark.read.parquet(target)
    assert sorted(r[0] for r in got.selectExpr("get_json_object(raw_json, '$.id')").collect()) == sorted(f"{s}{i}" for s, n in SIZES.items() for i in range(n))
    assert got.groupBy("search", "page", "pos").count().filter("count > 1").count() == 0
    assert service.calls() == sorted((s, str(p)) for s, n in {"none": 1, "short": 1, "full": 3, "long": 7}.items() for p in range(1, n + 1))


def test_a_failed_round_is_read_again(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    inner, broken = CountedService(str(tmp_path / "calls"), SIZES, 3), tmp_path / "broken"
    broken.write_text("x")

    def fetch(request, page):
        if page == 4 and broken.exists():
            raise OSError("no answer")
        return inner(request, page)

    progress, target, checkpoint = (str(tmp_path / n) for n in ("progress", "target", "checkpoint"))

    def started():
        stream = stream_searches(spark, [(s, {"search": s}) for s in SIZES], fetch, 3, progress, pages_per_round=2)
        return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).start(target)

    with pytest.raises(Exception, match="no answer"):
        started().processAllAvailable()
    broken.unlink()
    query = started()
    query.processAllAvailable()
    query.stop()
    ids = [r[0] for r in spark.read.parquet(target).selectExpr("get_json_object(raw_json, '$.id')").collect()]
    assert sorted(ids) == sorted(f"{s}{i}" for s, n in SIZES.items() for i in range(n))


def test_a_long_search_takes_few_batches(spark, tmp_path):
    progress, target, checkpoint = (str(tmp_path / n) for n in ("progress", "target", "checkpoint"))
    fetch = lambda request, page: [{"id": page}] if page <= 40 else []
    stream = stream_searches(spark, [("a", {})], fetch, 1, progress, pages_per_round=1)
    query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).start(target)
    query.processAllAvailable()
    batches = query.lastProgress["batchId"] + 1
    query.stop()
    got = spark.read.parquet(target).selectExpr("page", "get_json_object(raw_json, '$.id')").collect()
    assert sorted((r[0], int(r[1])) for r in got) == [(n, n) for n in range(1, 41)]
    assert batches <= 8


def got_order():
    from pyspark.sql import functions as F

    return F.col("source_file")


def test_read_pages(spark, folder, rows):
    path = folder(a__html="<p>\nx</p>")
    assert rows(files.read_pages(spark, path).select("page_id", "html")) == [("a.html", "<p>\nx</p>")]
