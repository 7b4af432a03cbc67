import datetime as dt

import pytest
from pyspark.sql import functions as F

from chartloom.functions import values
from chartloom.schemas import clean_nans


@pytest.mark.parametrize(
    "raw, n",
    [(" 12 ", 12), ("1e3", 1000), ("12.7", 12), ("inf", None), ("-inf", None), ("nan", None), ("UNKNOWN", None), ("", None), (None, None)],
)
def test_to_int(value, raw, n):
    assert value(values.to_int, raw) == n
    assert value(values.to_int_or_zero, raw) == (n or 0)


@pytest.mark.parametrize("n, out", [(-1, 0), (0, 0), (10, 10), (15, 15), (99, 15)])
def test_comment_limit(value, n, out):
    assert value(values.clamp_comment_limit, n, types=["int"]) == out
    assert values.comment_limit(n) == out


@pytest.mark.parametrize("a, b, score", [(1990, 1994, 100), (1990, 1985, 50), (1990, 1996, 0), (None, 1990, 0), (1990, None, 0), (0, 2, 0)])
def test_year_score(value, a, b, score):
    assert value(values.year_score, a, b, types=["int", "int"]) == score


@pytest.mark.parametrize(
    "status, name",
    [
        ("Success (Strict)", "Success (Lyrics Found)"),
        ("Lyrics Empty (Heuristic)", "Found (No Lyrics)"),
        ("Song Not Found", "Song Not Found"),
        ("Ambiguous Match (No Year)", "Ambiguous Match"),
        ("Error (Timeout)", "Error / Pending"),
        (None, "Error / Pending"),
        ("by hand", "Other"),
    ],
)
def test_status_class(value, status, name):
    assert value(values.status_class, status) == name


def test_needs_work(value):
    assert value(values.needs_work, None) is True
    assert value(values.needs_work, "Search Error: x") is True
    assert value(values.needs_work, "Success") is False
    assert value(lambda c: F.coalesce(values.needs_work(c, retry_errors=False), F.lit(False)), "Error (Code)") is False


def test_iso_text(value):
    assert value(values.iso_text, dt.datetime(2024, 1, 2, 3, 4, 5), types=["timestamp_ntz"]) == "2024-01-02T03:04:05"
    assert value(values.iso_text, dt.datetime(2024, 1, 2, 3, 4, 5, 60), types=["timestamp_ntz"]) == "2024-01-02T03:04:05.000060"


def test_nan_is_null(spark):
    df = spark.createDataFrame([(float("nan"), 1.0, "nan")], "a double, b double, c string")
    assert tuple(clean_nans(df).first()) == (None, 1.0, "nan")


def test_arrays(value):
    assert value(values.drop_empty, ["a", "", None, "b"], types=["array<string>"]) == ["a", "b"]
    assert value(values.or_empty, None, types=["array<string>"]) == []
    assert value(lambda c: values.head_of(c, 0), ["a"], types=["array<string>"]) == []


def test_candidates(value):
    kinds = ["array<struct<youtube_id:string,youtube_url:string>>", "string", "string"]

    def run(*args):
        return [tuple(x) for x in value(values.candidate_list, *args, types=kinds)]

    watch = "https://www.youtube.com/watch?v="
    assert run([("a", None), (None, "u?v=abcdef"), (None, "none")], "x", None) == [("a", watch + "a"), ("abcdef", "u?v=abcdef")]
    assert run([(None, "none")], "x", "") == [("x", watch + "x")]
    assert run(None, None, "u?v=123456") == [("123456", "u?v=123456")]
    assert run([], "", "nothing") == []


def test_is_filled(spark):
    df = spark.createDataFrame([(1, (None, None)), (2, (None, 1.0)), (3, None)], "i int, s struct<a:double,b:double>")
    rows = df.select("i", values.is_filled(F.col("s"), ["a", "b"]).alias("f")).collect()
    assert {r.i: r.f for r in rows} == {1: False, 2: True, 3: False}
