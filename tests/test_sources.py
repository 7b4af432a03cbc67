import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from chartloom.schemas import require, with_columns

YEAR_LINKS = "year string, url string"
from chartloom.session import new_workspace, shared_folder
from chartloom.sources import tables, yaml_text

NASTY = ['plain', 'say "hi"', "line\nbreak", "comma, é", "", "null", "~ # : - {}", "tab\tx", " \x85\x7f﻿ end", "back\\slash", "日本 😀"]


def test_folder_comes_from_the_session(spark):
    assert new_workspace(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_csv_and_json_keep_texts(spark):
    df = spark.createDataFrame([(i, t or None, float(i)) for i, t in enumerate(NASTY)], "i int, t string, x double")
    for suffix, write in ((".csv", tables.write_csv), (".json", tables.write_json)):
        path = new_workspace(spark, "rt") + suffix
        write(df, path)
        back = tables.read_records(spark, path, "i int, t string, x double, absent string", lines=True)
        got = {r.i: (r.t, r.x, r.absent) for r in back.collect()}
        assert got == {i: (t or None, float(i), None) for i, t in enumerate(NASTY)}


def test_json_document_with_nan(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('[{"name": "a", "x": NaN}, {"name": "b", "x": 2.5}]')
    assert sorted(tuple(r) for r in tables.read_records(spark, str(path), "name string, x double").collect()) == [("a", None), ("b", 2.5)]


def test_missing_inputs(spark, tmp_path):
    for name in ("no.json", "no.csv"):
        assert tables.read_optional(spark, str(tmp_path / name), YEAR_LINKS).count() == 0
        with pytest.raises(AnalysisException):
            tables.read_records(spark, str(tmp_path / name), YEAR_LINKS).count()


def test_csv_to_json(spark, tmp_path):
    full, empty = tmp_path / "f.csv", tmp_path / "e.csv"
    full.write_text('year,url\n1946,"http://a\nb"\n')
    empty.write_text("year,url\n")
    assert tables.csv_to_json(spark, str(full), str(tmp_path / "f.json"), YEAR_LINKS)
    assert spark.read.json(str(tmp_path / "f.json")).count() == 1
    assert not tables.csv_to_json(spark, str(empty), str(tmp_path / "e.json"), YEAR_LINKS)
    assert not (tmp_path / "e.json").exists()


def test_source_order(spark, tmp_path):
    for f in range(4):
        lines = "".join(json.dumps({"f": f, "i": i}) + "\n" for i in range(50 * (4 - f)))
        (tmp_path / f"part{f}.json").write_text(lines)
    rows = tables.with_source_order(spark.read.schema("f int, i int").json(str(tmp_path))).collect()
    assert [(r.f, r.i) for r in sorted(rows, key=lambda r: r.ord)] == [(f, i) for f in range(4) for i in range(50 * (4 - f))]
    assert sorted(r.ord for r in rows) == list(range(len(rows)))


def test_publish_switches_versions(spark):
    root = new_workspace(spark, "pub")
    assert tables.read_published(spark, root, "n int").count() == 0
    assert tables.publish(spark.createDataFrame([(1,)], "n int"), root) == 1
    old = tables.read_published(spark, root, "n int")
    assert tables.publish(old.unionByName(spark.createDataFrame([(2,)], "n int")), root) == 2
    assert sorted(r.n for r in tables.read_published(spark, root, "n int").collect()) == [1, 2]
    assert old.count() == 1

    def broken(batches):
        raise RuntimeError("lost")
        yield

    with pytest.raises(Exception):
        tables.publish(old.mapInPandas(broken, "n int"), root)
    assert tables.read_published(spark, root, "n int").count() == 2


def test_publish_appends_without_rewriting(spark):
    root = new_workspace(spark, "pub")
    some = lambda *n: spark.createDataFrame([(x,) for x in n], "n int")
    assert [tables.publish(some(*n), root, append=True) for n in ((1, 2), (3,), ())] == [1, 2, 2]
    old = tables.read_published(spark, root, "n int")
    assert len({Path(f).parent for f in old.inputFiles()}) == 2
    assert sorted(r.n for r in old.collect()) == [1, 2, 3]
    assert tables.publish(some(9), root) == 3
    assert [r.n for r in tables.read_published(spark, root, "n int").collect()] == [9] and old.count() == 3


def test_two_writers_of_a_version_lose_no_rows(spark, monkeypatch):
    """Both read the log before either has logged."""
    root, seen = new_workspace(spark, "pub"), tables._current
    some = lambda n: spark.createDataFrame([(n,)], "n int")
    tables.publish(some(0), root)
    before = seen(spark, root)
    monkeypatch.setattr(tables, "_current", lambda *_: before)
    assert tables.publish(some(1), root, append=True) == tables.publish(some(2), root, append=True) == 2
    monkeypatch.undo()
    assert sorted(r.n for r in tables.read_published(spark, root, "n int").collect()) == [0, 1, 2]


def test_json_is_told_by_its_first_line(spark, tmp_path):
    shapes = {"lines": '{"n": 1}\n{"n": 2}\n', "array": '[{"n": 1}, {"n": 2}]', "spread": '[\n  {\n "n": 1\n},{"n": 2}]', "none": ""}
    for name, text in shapes.items():
        (tmp_path / f"{name}.json").write_text(text)
        got = tables.read_records(spark, str(tmp_path / f"{name}.json"), "n int").collect()
        assert sorted(r.n for r in got) == ([] if name == "none" else [1, 2]), name


def test_stage_runs_once(spark):
    root, calls = new_workspace(spark, "stage"), []

    def build():
        calls.append(1)
        return spark.createDataFrame([(7,)], "n int")

    assert tables.stage(spark, root, build).first().n == 7
    assert tables.stage(spark, root, build).first().n == 7
    assert calls == [1]


def test_yaml_document(spark):
    yaml = pytest.importorskip("yaml")
    shape = (
        "ord bigint, name string, x double, flag boolean, lyrics struct<text:string,n:bigint>, awards array<string>,"
        " comments array<struct<id:string,inner:struct<a:int>,tags:array<string>>>, none string, empty array<string>"
    )
    floats = [1.5, 1e20, 1e-9, float("inf"), 0.0, -2.0, None]
    rows = [
        (i, t, floats[i % len(floats)], i % 2 == 0, (t, i) if i % 3 else None, [t, "b"], [(t, (i,), [t]), ("z", None, [])], None, [])
        for i, t in enumerate(NASTY)
    ]
    df = spark.createDataFrame(rows, shape).repartition(3)
    path = new_workspace(spark, "yaml")
    yaml_text.write_yaml(df, path, "ord", shards=3)
    text = "".join(p.read_text("utf-8") for p in sorted(Path(path).glob("part-*")))
    got = yaml.safe_load(text)
    assert [g["name"] for g in got] == NASTY
    assert list(got[0]) == ["name", "x", "flag", "lyrics", "awards", "comments", "none", "empty"]
    for g, (i, t, x, flag, lyrics, awards, *_rest) in zip(got, rows):
        assert g["x"] == x and g["flag"] is flag and g["awards"] == awards and g["none"] is None and g["empty"] == []
        assert g["lyrics"] == (None if lyrics is None else {"text": t, "n": i})
        assert g["comments"] == [{"id": t, "inner": {"a": i}, "tags": [t]}, {"id": "z", "inner": None, "tags": []}]


def test_yaml_is_read_back(spark):
    """What is written comes back, strings, numbers, nested lists and NULLs; from one file in several tasks."""
    shape = (
        "name string, x double, flag boolean, lyrics struct<text:string,n:bigint>, awards array<string>,"
        " comments array<struct<id:string,inner:struct<a:int>,tags:array<string>>>, none string, empty array<string>, n int"
    )
    floats = [1.5, 1e20, 1e-9, float("inf"), -2.0, None]
    rows = [
        (t, floats[i % len(floats)], i % 2 == 0, (t, i) if i % 3 else None, [t, "b"] if i % 4 else None,
         [(t, (i,), [t, "- x: y"]), ("z", None, []), (None, (None,), None)], None, [], i)
        for i, t in enumerate([*NASTY, "\n- name: trap\n  n: 3", "  n: 5", "[]", "~", "it's"])
    ]
    df = spark.createDataFrame(rows, shape)
    path = new_workspace(spark, "yaml")
    yaml_text.write_yaml(df.withColumn("ord", F.col("n")), path, "ord", shards=1)
    got = {r.n: r for r in yaml_text.read_yaml(spark, path, f"{shape}, absent array<int>").collect()}
    want = {r.n: r for r in df.collect()}
    assert len(got) == len(rows)
    for n, r in want.items():
        assert got[n].absent is None and tuple(got[n])[:-1] == tuple(r)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        again = yaml_text.read_yaml(spark, path, shape)
        assert again.rdd.getNumPartitions() > 3 and sorted(r.n for r in again.collect()) == sorted(want)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_plain_yaml_is_read(spark, tmp_path):
    (tmp_path / "a.yaml").write_text("- name: A song\n  tags:\n  - one\n  - 'it''s'\n  n: 4\n- n: 5\n  name: ~\n  tags: []\n")
    (tmp_path / "none.yaml").write_text("[]\n")
    shape = "name string, n int, tags array<string>"
    assert [tuple(r) for r in yaml_text.read_yaml(spark, str(tmp_path / "a.yaml"), shape).collect()] == [
        ("A song", 4, ["one", "it's"]), (None, 5, [])
    ]
    assert yaml_text.read_yaml(spark, str(tmp_path / "none.yaml"), shape).count() == 0


def test_schema_checks(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert require(df, "a") is df
    with pytest.raises(ValueError, match="missing column"):
        require(df, "a", "spotify_track_id")
    assert with_columns(df, {"a": "string", "b": "bigint"}).dtypes == [("a", "int"), ("b", "bigint")]


def test_counts_by_observation(spark):
    """Rows written, counted while they are written."""
    df, seen = tables.with_row_count(spark.range(10))
    tables.write_json(df, new_workspace(spark, "obs"))
    assert seen.get["rows"] == 10


