from __future__ import annotations

from pyspark.sql import functions as F

from jobscape.llm import licenses

SCHEMA = "file long, path string, text string, is_license_file boolean"


def test_own_and_inherited(spark):
    rows = [
        (1, "/a/LICENSE", "Licensed under the Apache License, Version 2.0.", True),
        (2, "/a/b/c/x.txt", "nothing here", False),
        (3, "/a/b/LICENSE", "intro\nReleased under the MIT License\nmore", True),
        (4, "/a/y.txt", "This work is licensed under the GNU General Public License, version 3.\nReleased, perhaps.", False),
        (5, "/z/q.txt", "plain", False),
        (6, "/ab/q.txt", "plain", False),
        (7, "/a/b/LICENSE", None, True),
        (8, None, "Licensed under CC BY-NC 4.0.", False),
        (9, None, "", None),
        (10, "/a/b/c/x.txt", "nothing here", False),
        (10, "/a/b/c/x.txt", "nothing here", False),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("license", F.lit(1)).withColumn("term", F.lit(1)).withColumn("folder", F.lit(1))
    got = sorted(((r.file, r.license, r.origin, r.inherited_from) for r in licenses.scan(df).collect()), key=str)
    assert got == sorted(
        [
            (1, "Apache-2.0", "own", None), (2, "MIT", "inherited", "/a/b"), (3, "MIT", "own", None), (4, "GPL-3.0", "own", None),
            (5, None, "none", None), (6, None, "none", None), (7, "MIT", "inherited", "/a/b"), (8, "CC-BY-NC-4.0", "own", None),
            (9, None, "none", None), (10, "MIT", "inherited", "/a/b"), (10, "MIT", "inherited", "/a/b"),
        ],
        key=str,
    )


def test_every_template_names_itself(spark):
    rows = [(i, f"/{i}/f", f"x y z\n{text}\nend", False) for i, text in enumerate(licenses.TEMPLATES.values())]
    got = {r.file: r.license for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i] for i in range(len(rows))] == list(licenses.TEMPLATES)


def test_root_directory_reaches_everything(spark):
    rows = [(1, "/LICENSE", "Released under the MIT License.", True), (2, "/a/b/c", "x", False), (3, "/b", "y", False)]
    got = {r.file: (r.license, r.inherited_from) for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: ("MIT", None), 2: ("MIT", ""), 3: ("MIT", "")}


def test_no_files_and_no_python(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert licenses.scan(empty).count() == 0
    plan = licenses.own_licenses(empty)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
