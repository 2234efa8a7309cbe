from __future__ import annotations

import json

import pytest

from jobscape.operators import flatten, profile, reports

RECORDS = [
    {"id": 1, "nom": "a\nb", "lieu": {"code": "69", "lat": None}, "tags": [{"l": "x"}, {"l": "y"}], "vide": []},
    {"id": 2, "nom": None, "lieu": {"code": 7, "lat": 1.5}, "tags": [], "at": "2026-04-06T09:58:27.930Z", "ok": True},
    {"id": 3.0, "lieu": {}, "tags": [{"l": "x"}, None], "mix": {"a": 1}, "non": None},
    {"id": 4, "nom": "a\nb", "mix": 3},
]


@pytest.fixture
def records(spark):
    data = [(i, json.dumps(r)) for i, r in enumerate(RECORDS)] + [(9, "  ")]
    return spark.createDataFrame(data, "n int, raw string").repartition(3)


def test_field_profile(records):
    got = {r["field_path"]: r for r in profile.json_field_profile(records, "raw", ["n"]).collect()}
    assert set(got) == {
        "id", "nom", "lieu", "lieu.code", "lieu.lat", "tags", "tags[]", "tags[].l", "vide", "at", "ok", "mix", "mix.a", "non",
    }
    line = lambda p: (
        got[p]["presence_count"], got[p]["non_null_count"], got[p]["presence_rate_pct"], got[p]["observed_types"],
        got[p]["suggested_type"], got[p]["examples"],
    )
    assert line("id") == (4, 4, 100.0, ["float", "int"], "FLOAT64", ["1", "2", "3"])
    # Present with null counts as present; absent does not.
    assert line("nom") == (3, 2, 75.0, ["null", "str"], "STRING", ["a\\nb"])
    assert line("lieu.lat") == (2, 1, 50.0, ["float", "null"], "FLOAT64", ["1.5"])
    assert line("lieu.code") == (2, 2, 50.0, ["int", "str"], "STRING", ["69", "7"])
    assert line("tags[]") == (4, 3, 100.0, ["dict", "null"], "JSON", [])
    assert line("tags[].l") == (3, 3, 75.0, ["str"], "STRING", ["x", "y"])
    assert line("at")[3:5] == (["timestamp_str"], "TIMESTAMP")
    assert line("ok")[3:] == (["bool"], "BOOL", ["true"])
    assert line("mix")[3:5] == (["dict", "int"], "JSON")
    assert line("non")[3:] == (["null"], "STRING", [])


def test_rate_passes_100_for_list_elements(spark):
    df = spark.createDataFrame([(1, '{"t": [1, 2, 3]}')], "n int, raw string")
    got = {r["field_path"]: r["presence_rate_pct"] for r in profile.json_field_profile(df, "raw", ["n"]).collect()}
    assert got == {"t": 100.0, "t[]": 300.0}


def test_examples_are_the_first_three_distinct_in_reading_order(spark):
    data = [(i, json.dumps({"v": v})) for i, v in enumerate("aabbbaccddee" * 50)]
    df = spark.createDataFrame(data, "n int, raw string").repartition(8)
    assert profile.json_field_profile(df, "raw", ["n"]).first()["examples"] == ["a", "b", "c"]


@pytest.mark.parametrize("line", ['{"a": ', "[1]"])
def test_bad_record_fails(spark, line):
    df = spark.createDataFrame([(1, line)], "n int, raw string")
    with pytest.raises(Exception, match="invalid JSON|not a JSON object"):
        profile.json_field_profile(df, "raw", ["n"]).collect()


def test_field_catalog(records):
    got = {r["field_path"]: r for r in profile.field_catalog(records, "raw", ["n"]).collect()}
    assert set(got) == {"id", "nom", "lieu.code", "lieu.lat", "tags", "vide", "at", "ok", "mix", "mix.a", "non"}
    assert [got["lieu.code"][c] for c in ("column_name", "column_type", "presence_count", "example_value")] == ["lieu__code", "TEXT", 2, "69"]
    assert got["tags"]["example_value"] == '[{"l": "x"}, {"l": "y"}]'
    assert got["id"]["column_type"] == "REAL" and got["ok"]["column_type"] == "INTEGER" and got["non"]["example_value"] is None


def test_observed_values(records, rows):
    got = rows(profile.observed_values(records, "raw", ["tags[].l", "lieu.code", "mix", "nope"]).filter("value is not null"))
    assert got == [("lieu.code", "69"), ("lieu.code", "7"), ("mix", "3"), ("tags[].l", "x"), ("tags[].l", "y")]


def test_observed_keys(records):
    assert {r[0] for r in profile.observed_keys(records, "raw").collect()} == {k for r in RECORDS for k in r}


def test_coverage(spark, rows):
    observed = spark.createDataFrame([("p", "1"), ("p", "2"), ("p", "3"), ("q", "x")], "field_path string, value string")
    listed = spark.createDataFrame([("r", "code", "1"), ("r", "code", "2"), ("r", "code", "9")], "referential string, key string, value string")
    got = profile.referential_coverage(observed, listed, {"p": ("r", "code"), "q": ("r", "none"), "z": ("r", "code")})
    assert rows(got.select("field_path", "n_values", "n_matched", "coverage_pct")) == sorted(
        [("p", 3, 2, 66.67), ("q", 1, 0, None), ("z", 0, 0, None)], key=repr
    )


def test_completion_report(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "a int, b string")
    assert [tuple(r) for r in reports.completion_report(df).collect()] == [("a", 3, 0, 100.0), ("b", 1, 2, 33.33)]


NESTED = "id int, lieu struct<code string, pos struct<lat double>>, tags array<string>, ok boolean"


@pytest.fixture
def nested(spark):
    return spark.createDataFrame([(1, ("69", (1.5,)), [], True), (2, None, ["é"], None)], NESTED)


def test_flatten_all_levels(nested):
    got = flatten.flatten_record(nested)
    assert got.columns == ["id", "lieu__code", "lieu__pos__lat", "tags", "ok"]
    assert [tuple(r) for r in got.collect()] == [(1, "69", 1.5, "[]", True), (2, None, None, '["é"]', None)]


def test_flatten_empty_list_null(nested):
    got = flatten.flatten_record(nested, sep=".", empty_list_null=True)
    assert [r["tags"] for r in got.collect()] == [None, '["é"]'] and "lieu.pos.lat" in got.columns


def test_flatten_one_level_keeps_parent(nested):
    got = flatten.flatten_record(nested, max_depth=1, keep_parent=True, null_as="")
    assert got.columns == ["id", "lieu", "lieu__code", "lieu__pos", "tags", "ok"]
    assert tuple(got.collect()[1]) == ("2", "", "", "", '["é"]', "")
    assert got.first()["lieu"] == '{"code":"69","pos":{"lat":1.5}}'


def test_records_are_read_and_parsed_once(spark, records):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    listed = spark.createDataFrame([("r", "code", "69")], "referential string, key string, value string")
    passed = records.mapInArrow(counted, records.schema)
    report = profile.json_field_profile(passed, "raw", ["n"], referentials=listed, hints={"lieu.code": ("r", "code")})
    rows = report.collect()
    assert reads.value == len(RECORDS) + 1
    assert "MapInArrow" not in report._jdf.queryExecution().executedPlan().toString()
    states = profile.field_states(records, "raw", ["n"], 120, True, 3, ["lieu.code"])
    plan = states._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan.split("MapInArrow")[0]
    assert {(r["referential"], r["coverage_pct"]) for r in rows if r["field_path"] == "lieu.code"} == {("r.code", 50.0)}
    assert all(r["referential"] is None for r in rows if r["field_path"] != "lieu.code")
    before = reads.value
    profile.field_catalog(passed, "raw", ["n"]).collect()
    assert reads.value - before == len(RECORDS) + 1


def test_values_of_a_hinted_path_pass_in_parts(spark, monkeypatch):
    monkeypatch.setattr(profile, "HELD_VALUES", 10)
    df = spark.createDataFrame([(i, json.dumps({"v": i % 70})) for i in range(500)], "n int, raw string").repartition(3)
    states = profile.field_states(df, "raw", ["n"], 120, True, 3, ["v"])
    assert states.filter("value is not null").select("value").distinct().count() == 70
    assert {r["n"] for r in states.filter("value is not null").select("n").collect()} == {0}
