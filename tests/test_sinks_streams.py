from __future__ import annotations

import datetime as dt
import json
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from jobscape import schemas
from jobscape.plans import daily
from jobscape.session import scratch_path, shared_dir
from jobscape.sinks import files as to_files, tables
from jobscape.streaming import ingest, trends


def texts(folder):
    return [open(os.path.join(folder, f), encoding="utf-8").read() for f in os.listdir(folder) if f.startswith("part-")]


def test_write_ndjson_keeps_nulls_and_letters(spark, tmp_path):
    path = str(tmp_path / "out")
    to_files.write_ndjson(spark.createDataFrame([("é", None)], "a string, b int").coalesce(1), path)
    assert texts(path) == ['{"a":"é","b":null}\n']


def test_write_json_list(spark, tmp_path):
    df = spark.createDataFrame([("é", 1), (None, 2)], "a string, b int")
    for name, partitions in (("one", 1), ("two", 2)):
        to_files.write_json_list(df.repartition(partitions), str(tmp_path / name))
        lists = [json.loads(t) for t in texts(str(tmp_path / name)) if t]
        assert sorted(map(repr, sum(lists, []))) == sorted(map(repr, [{"a": "é", "b": 1}, {"a": None, "b": 2}]))
        assert len(lists) <= partitions


def test_write_csv(spark, tmp_path):
    to_files.write_csv_report(spark.createDataFrame([("é", 1)], "a string, b int").coalesce(1), str(tmp_path / "out"), sep=";")
    assert texts(str(tmp_path / "out")) == ["a;b\né;1\n"]


def test_truncate_load(spark, rows):
    with pytest.raises(ValueError, match="does not exist"):
        tables.truncate_load(spark.range(1), "no_such_table")
    tables.materialize_table(spark.createDataFrame([(1, "x")], "a int, b string"), "tl")
    tables.truncate_load(spark.createDataFrame([("y", 2), ("z", 3)], "b string, a int"), "tl")
    assert rows(spark.table("tl")) == [(2, "y"), (3, "z")]
    spark.sql("drop table tl")


def test_replace_table(spark, rows):
    df = spark.createDataFrame([(1, None, [1])], "a int, b string, c array<int>")
    assert tables.replace_table(df, "rt") and rows(spark.table("rt")) == [("1", "", "[1]")]
    assert not tables.replace_table(df.filter("a > 1"), "rt2") and not spark.catalog.tableExists("rt2")
    spark.sql("drop table rt")


def test_layer_table():
    assert tables.layer_table(" marts ", "x") == "marts.x" and tables.layer_table(None, "x") == "staging.x"


def test_append_run(spark, rows):
    df = spark.createDataFrame([(1,)], "a int")
    tables.append_run(df, "audit", "r1")
    tables.append_run(df, "audit", "r2")
    assert rows(spark.table("audit")) == [(1, "r1"), (1, "r2")]
    spark.sql("drop table audit")


def test_upsert_path_and_view(spark, tmp_path, rows):
    stored = spark.createDataFrame([(1, "a", 0)], "id int, v string, seq int")
    new = spark.createDataFrame([(1, "b", 2), (1, "c", 1)], "id int, v string, seq int")
    got = tables.upsert_path(stored, new, "id", ["seq"], str(tmp_path / "v2"))
    tables.create_view(got, "merged")
    assert rows(spark.sql("select v from merged")) == [("b",)]


def session(master, named):
    """Stands in for a session, whose shared folder is fixed when it starts."""
    conf = SimpleNamespace(get=lambda key, default: named if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"))


def test_shared_dir_is_the_named_one():
    cluster = session("spark://host:7077", "hdfs://host/shared/")
    assert shared_dir(cluster) == "hdfs://host/shared"
    paths = {scratch_path(cluster, "x") for _ in range(3)}
    assert len(paths) == 3 and all(p.startswith("hdfs://host/shared/x-") for p in paths)
    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(RuntimeError, match="every executor"):
            shared_dir(session(master, None))
    assert os.path.isdir(shared_dir(session("local[2]", None)))


def write(folder, name, *records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("\n".join(json.dumps(r) for r in records))


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_ingest_once_and_archive(spark, tmp_path, rows):
    landing, archive, target, state = (str(tmp_path / n) for n in ("raw", "done", "table", "state"))
    write(landing, "a.ndjson", {"code": "1", "type": "x"})
    for names in (["b.ndjson"], ["c.ndjson"], []):
        run(ingest.ingest(ingest.landing_stream(spark, landing, schemas.REGIONS, archive), target, state))
        for name in names:
            write(landing, name, {"code": name[0]})
    assert rows(spark.read.parquet(target).select("code")) == [("1",), ("b",), ("c",)]
    archived = {f for _, _, found in os.walk(archive) for f in found}
    # The files of one run are moved by the next.
    assert "a.ndjson" in archived and "a.ndjson" not in os.listdir(landing)


def test_upsert_stream(spark, tmp_path, rows):
    landing, root, state = (str(tmp_path / n) for n in ("raw", "table", "state"))
    layout = "id string, v int, seq int"
    write(landing, "a.ndjson", {"id": "1", "v": 1, "seq": 1}, {"id": "2", "v": 1, "seq": 1})
    run(ingest.upsert_stream(ingest.landing_stream(spark, landing, layout), root, ["id"], ["seq"], state))
    write(landing, "b.ndjson", {"id": "1", "v": 2, "seq": 2}, {"id": "1", "v": 5, "seq": 0}, {"id": "3", "v": 2, "seq": 2})
    run(ingest.upsert_stream(ingest.landing_stream(spark, landing, layout), root, ["id"], ["seq"], state))
    # A later batch wins over an earlier one even where its order column is smaller.
    write(landing, "c.ndjson", {"id": "2", "v": 9, "seq": 0})
    run(ingest.upsert_stream(ingest.landing_stream(spark, landing, layout), root, ["id"], ["seq"], state))
    got = ingest.merged_rows(spark, root, ["id"], ["seq"])
    assert got.columns == ["id", "v", "seq"]
    assert rows(got.select("id", "v")) == [("1", 2), ("2", 9), ("3", 2)]


def test_a_root_has_one_checkpoint(spark, tmp_path, rows):
    landing, root, state = (str(tmp_path / n) for n in ("raw", "table", "state"))
    layout = "id string, v int, seq int"
    add = lambda at, to: ingest.upsert_stream(ingest.landing_stream(spark, landing, layout), to, ["id"], ["seq"], at)
    write(landing, "a.ndjson", {"id": "1", "v": 1, "seq": 1}, {"id": "2", "v": 1, "seq": 1})
    run(add(state, root))
    write(landing, "b.ndjson", {"id": "2", "v": 2, "seq": 2})
    run(add(state, root))
    with pytest.raises(Exception, match="another checkpoint"):
        add(state + "2", root).awaitTermination()
    got = lambda r: rows(ingest.merged_rows(spark, r, ["id"], ["seq"]).select("id", "v"))
    assert got(root) == [("1", 1), ("2", 2)]
    # Compacted rows take a new checkpoint, whose batches win over them.
    ingest.compact(spark, root, root + "2", ["id"], ["seq"])
    assert got(root + "2") == [("1", 1), ("2", 2)]
    for name in os.listdir(landing):
        os.remove(os.path.join(landing, name))
    write(landing, "c.ndjson", {"id": "1", "v": 7, "seq": 0})
    run(add(state + "3", root + "2"))
    assert got(root + "2") == [("1", 7), ("2", 2)]


def test_upsert_stream_refuses_missing_key(spark, tmp_path):
    landing, root, state = (str(tmp_path / n) for n in ("raw", "table", "state"))
    write(landing, "a.ndjson", {"v": 1, "seq": 1})
    query = ingest.upsert_stream(ingest.landing_stream(spark, landing, "id string, v int, seq int"), root, ["id"], ["seq"], state)
    with pytest.raises(Exception, match="null in key column"):
        query.awaitTermination()


def test_dedupe_stream(spark, tmp_path, rows):
    landing, target, state = (str(tmp_path / n) for n in ("raw", "table", "state"))
    layout = "id string, at timestamp"
    for name in ("a.ndjson", "b.ndjson"):
        write(landing, name, {"id": "1", "at": "2026-04-06T10:00:00Z"}, {"id": name, "at": "2026-04-06T11:00:00Z"})
        stream = ingest.dedupe_stream(ingest.landing_stream(spark, landing, layout), ["id"], "at", "1 day")
        run(ingest.ingest(stream, target, state))
    assert rows(spark.read.parquet(target).select("id")) == [("1",), ("a.ndjson",), ("b.ndjson",)]


def test_trend_stream_equals_batch(spark, tmp_path, rows):
    landing, target, state = (str(tmp_path / n) for n in ("raw", "table", "state"))
    write(landing, "a.ndjson", *[{"id": str(i), "at": f"2026-04-0{1 + i % 4}T10:00:00Z"} for i in range(10)])
    stream = trends.trend_stream(ingest.landing_stream(spark, landing, "id string, at timestamp"), "at", "1 hour")
    run(ingest.ingest(stream, target, state))
    # The last day is still open.
    assert rows(spark.read.parquet(target)) == [
        (dt.date(2026, 4, 1), 3), (dt.date(2026, 4, 2), 3), (dt.date(2026, 4, 3), 2),
    ]


def test_daily_run(spark, tmp_path, rows):
    """Landed files to offer tables, and what the declared checks find."""
    from tests import fixtures

    landing = {}
    frames = dict(zip(("communes", "departements", "regions", "epcis"), fixtures.place_lists(spark)))
    frames |= {"coded_offers": fixtures.coded_offers(spark), "named_offers": fixtures.named_offers(spark)}
    for name, df in frames.items():
        to_files.write_ndjson(df, str(tmp_path / name))
        landing[name] = f"{tmp_path / name}/*.json"
    for layer in ("staging_t", "offers_t"):
        spark.sql(f"create database {layer}")
    staged = daily.load_staging(spark, landing, "staging_t")
    built = daily.build_offers(spark, staged, "offers_t")
    assert {n: t.count() for n, t in built.items()} == {"communes": 5, "coded_offers": 4, "named_offers": 5}
    failing = {n: df.count() for n, df in daily.checks(built).items() if not df.isEmpty()}
    assert failing == {
        "communes.departement_code not null": 1, "coded_offers.offer_id unique": 1,
        "named_offers.offer_id unique": 1, "coded_offers have a department": 1,
    }
    for layer in ("staging_t", "offers_t"):
        spark.sql(f"drop database {layer} cascade")


def test_required_column_stops_the_load(spark, tmp_path):
    write(str(tmp_path / "in"), "a.ndjson", {"id": "1"}, {"intitule": "x"})
    spark.sql("create database staging_q")
    with pytest.raises(Exception, match="null in key column"):
        daily.load_staging(spark, {"coded_offers": f"{tmp_path}/in/*.ndjson"}, "staging_q")
    spark.sql("drop database staging_q cascade")


FETCHED = "id bigint, search_no int, page int, pos int, title string, at timestamp"


def test_first_in_search_order_whatever_the_arrival(spark, tmp_path):
    """Shuffled batches give the rows that the whole table would keep; answered keys leave the state."""
    import datetime as dt
    import random

    from jobscape.operators.dedupe import keep_first
    from jobscape.streaming.first_in_order import first_in_order_stream

    rng = random.Random(3)
    start = dt.datetime(2026, 1, 1)
    rows = []
    for day in range(6):
        for n in range(40):
            at = start + dt.timedelta(days=day, minutes=rng.randint(0, 600))
            for _ in range(rng.randint(1, 5)):
                search = rng.choice([0, 1, 2, None])
                rows.append((day * 100 + n, search, rng.randint(1, 3), rng.randint(0, 9), rng.choice(["a", None]), at + dt.timedelta(minutes=rng.randint(0, 300))))
    landing, target, state = (str(tmp_path / n) for n in ("landing", "target", "state"))
    order = ["search_no", "page", "pos"]
    sizes = []
    for day in range(6):
        batch = [r for r in rows if r[0] // 100 == day]
        rng.shuffle(batch)
        for part in (batch[::2], batch[1::2]):
            spark.createDataFrame(part, FETCHED).coalesce(1).write.mode("append").parquet(landing)
            stream = first_in_order_stream(spark.readStream.schema(FETCHED).parquet(landing), ["id"], order, "at", "1 day")
            query = stream.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(target)
            query.awaitTermination()
            assert query.exception() is None
            sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = spark.read.parquet(target)
    whole = keep_first(spark.createDataFrame(rows, FETCHED), ["id"], order)
    answered = {r["id"]: tuple(r[c] for c in order) for r in got.collect()}
    assert got.count() == len(answered) and len(answered) >= 4 * 40 - 40
    want = {r["id"]: tuple(r[c] for c in order) for r in whole.collect()}
    assert all(want[i] == found for i, found in answered.items())
    # A value and its timer entries for the keys of the last days, not of all.
    assert max(sizes[-4:]) <= max(sizes[:6]) * 1.2


def test_first_in_search_order_in_any_session(spark, tmp_path):
    """The query answers where the session keeps the state of streams in the store Spark has by default."""
    from jobscape.session import STATE_STORE
    from workload.streams import stream_first_in_order

    start = dt.datetime(2026, 1, 1)
    rows = [(n, start + dt.timedelta(days=n // 3)) for n in range(90)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    plain = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, plain)
    try:
        got = stream_first_in_order(spark, str(tmp_path)).collect()
        assert spark.conf.get(STATE_STORE) == plain
    finally:
        spark.conf.set(STATE_STORE, before)
    want = [(n, s, (n + s) % 5, n % 7) for n, at in rows if at <= rows[-1][1] - dt.timedelta(days=16) for s in [0 if n % 3 else 1]]
    assert sorted(map(tuple, got)) == want


def test_first_in_search_order_keeps_many_keys_in_few_values(spark, tmp_path):
    """A call of Python and a value of the state hold many keys; large numbers stay whole where others are missing."""
    from jobscape.streaming.first_in_order import first_in_order_stream

    start, high, nan = dt.datetime(2026, 1, 1), 1 << 60, float("nan")
    rows = [(high + n, None, s, high + n + s if s else None, start + dt.timedelta(seconds=n)) for n in range(1500) for s in (2, 1)]
    # Keys that a grouping tells apart, and two zeros that it does not.
    rows += [(None, None, 3, 5, start), (None, nan, 4, 6, start), (None, 0.0, 6, 7, start), (None, -0.0, 5, 8, start), (7, 0.0, None, None, start)]
    rows += [(high, None, 1, high + 9, start + dt.timedelta(hours=1)), (7, 0.0, 0, 1, start)]
    last = (1, None, 1, 1, start + dt.timedelta(days=9))
    schema = "id bigint, name double, search_no int, offer bigint, at timestamp"
    landing, target, state = (str(tmp_path / n) for n in ("landing", "target", "state"))
    held = []
    for batch in (rows[::2], rows[1::2], [last]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(landing)
        stream = first_in_order_stream(spark.readStream.schema(schema).parquet(landing), ["id", "name"], ["search_no"], "at", "1 day")
        query = stream.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(target)
        query.awaitTermination()
        assert query.exception() is None
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    want = [(high + n, None, 1, high + n + 1) for n in range(1500)]
    want += [(None, None, 3, 5), (None, None, 4, 6), (None, 0.0, 5, 8), (7, 0.0, None, None)]
    assert sorted((tuple(r)[:4] for r in spark.read.parquet(target).collect()), key=repr) == sorted(want, key=repr)
    assert max(held) <= 600 and held[-1] <= 2


def test_only_changed_buckets_are_merged(spark, tmp_path):
    from jobscape.sinks.keyed import KeyedTable

    root = str(tmp_path / "keyed")
    table = KeyedTable(spark, root, ["id"], ["n"], buckets=8)
    df = lambda rows: spark.createDataFrame(rows, "id int, n int, v string")
    with pytest.raises(ValueError, match="no rows yet"):
        table.rows()
    want = {}

    def add(number, rows):
        table.add(df(rows), "run", number)
        for i, n, v in sorted(rows, key=lambda r: r[1]):
            want[i] = (i, n, v)

    shown = lambda: sorted(map(tuple, table.rows().collect()))
    add(0, [(i, 0, "a") for i in range(100)])
    add(1, [(5, 2, "b"), (5, 1, "c"), (200, 0, "d")])
    assert shown() == sorted(want.values())
    assert table.compact() == list(range(8)) and table.compact() == []
    assert shown() == sorted(want.values()) and "Exchange" not in table.rows()._jdf.queryExecution().executedPlan().toString()
    # One key changes one bucket: the other folders may even be unreadable.
    add(2, [(5, 3, "e")])
    (bucket,) = table.changed()
    for folder in (tmp_path / "keyed" / "merged" / "_v=1").glob("_bucket=*"):
        if folder.name != f"_bucket={bucket}":
            for file in folder.glob("part-*"):
                file.rename(file.with_suffix(".kept"))
                file.write_bytes(b"not parquet")
    assert table.compact() == [bucket]
    for file in (tmp_path / "keyed" / "merged" / "_v=1").glob("_bucket=*/*.kept"):
        file.rename(file.with_suffix(".parquet"))
    assert table.version()["merged"] == {str(b): 2 if b == bucket else 1 for b in range(8)}
    assert shown() == sorted(want.values())
    # A batch that is added again replaces itself; an old version stays as it was.
    add(3, [(7, 9, "x"), (8, 9, "y")])
    table.add(df([(7, 9, "z")]), "run", 3)
    want[7], want[8] = (7, 9, "z"), (8, 0, "a")
    assert shown() == sorted(want.values())
    assert {r["v"] for r in table.rows(1).filter("id = 5").collect()} == {"b"}
    with pytest.raises(ValueError, match="another run"):
        table.add(df([(1, 1, "q")]), "other", 0)
    table.compact()
    table.add(df([(1, 1, "q")]), "other", 0)
    want[1] = (1, 1, "q")
    assert shown() == sorted(want.values())
    with pytest.raises(ValueError, match="is keyed by id"):
        KeyedTable(spark, root, ["v"], ["n"])
    assert KeyedTable(spark, root, ["id"], ["n"], buckets=3).buckets == 8


def test_a_load_checks_its_rows_in_one_pass(spark, tmp_path):
    from jobscape.sinks.checked import load_checked

    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    schema = "id int, kind string, n int"
    df = spark.createDataFrame([(1, "a", 1), (2, "x", 2), (3, None, None), (None, "b", 99), (1, "a", 3)], schema).mapInArrow(counted, schema)
    layout = "id int not null, n int not null, kind string"
    loaded = load_checked(df, str(tmp_path / "load"), ["id"], {"kind": ["a", "b"]}, {"large, odd": F.col("n") > 50}, layout)
    assert sorted(map(tuple, loaded.rows.collect())) == [(1, "a", 1), (1, "a", 3)] and loaded.rows.columns == df.columns
    assert {r["id"]: r["broken"] for r in loaded.failing.collect()} == {
        2: ["accepted:kind"], 3: ["not_null:n"], None: ["not_null:id", "large, odd"],
    }
    assert dict(loaded.report().collect()) == {
        "rows": 5, "failing": 3, "not_null:id": 1, "not_null:n": 1, "accepted:kind": 1, "large, odd": 1,
    }
    assert [tuple(r) for r in loaded.repeated("id").collect()] == [(1, 2)]
    assert reads.value == 5
    nothing = load_checked(df.filter("id > 9"), str(tmp_path / "none"), ["id"])
    assert nothing.rows.count() == 0 and nothing.counts["rows"] == 0


def test_a_new_day_is_counted_from_its_own_offers(spark, tmp_path):
    from jobscape.plans import marts

    rows = [(i, f"2026-01-0{1 + i % 3}", f"2026-01-0{1 + i % 5}", f"e{i % 4}" if i % 6 else None, f"z{i % 2}", "s", f"t{i % 3}") for i in range(60)]
    schema = "id int, created string, updated string, employer string, zone string, sector string, size string"
    offers = spark.createDataFrame(rows, schema).withColumns({c: F.col(c).cast("timestamp") for c in ("created", "updated")})
    offers.withColumn("day", F.date_format("created", "dd")).write.partitionBy("day").parquet(str(tmp_path / "offers"))
    made = {
        "trend": (lambda df: marts.trend_states(df, "created", "updated", "employer"), marts.trend_from_states),
        "employers": (lambda df: marts.employer_states(df, "employer", "employer", "zone", "sector", "size"), marts.employers_from_states),
        "places": (
            lambda df: marts.place_states(df, ["zone"], "created", "employer", F.col("size") == "t1", F.col("id") > 3, F.lit(True)),
            lambda states: marts.places_from_states(states, ["zone"], "employer"),
        ),
    }
    for name, (states, answer) in made.items():
        kept = marts.StoredStates(spark, str(tmp_path / name))
        for day in ("01", "02"):
            kept.add(states(spark.read.parquet(str(tmp_path / "offers" / f"day={day}"))), day)
        # The other days cannot even be read while the last one is added.
        broken = [f for d in ("01", "02") for f in (tmp_path / "offers" / f"day={d}").glob("part-*")]
        content = [f.read_bytes() for f in broken]
        for f in broken:
            f.write_bytes(b"x")
        for _ in range(2):
            kept.add(states(spark.read.parquet(str(tmp_path / "offers" / "day=03"))), "03")
        for f, old in zip(broken, content):
            f.write_bytes(old)
        assert sorted(map(repr, answer(kept.all()).collect())) == sorted(map(repr, answer(states(offers)).collect()))
