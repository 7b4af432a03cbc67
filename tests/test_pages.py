import json

import pytest

from pyspark.sql import functions as F

from chartloom.functions import html
from chartloom.functions.payloads import embedded_json
from chartloom.operators import comments, pages

CHART = """<html><body><h1 id="firstHeading">Singles <i>x</i> of 1970</h1>
<table class="wikitable"><tbody><tr><td>no</td><td>no</td><td>no</td></tr></tbody></table>
<table class="sortable wikitable plain"><tbody>
<tr><th>No.</th><th>Title</th><th>Artist</th></tr>
<tr><td> 1
</td><td>"<a href="/wiki/One">One</a> <b>more</b>"</td><td><a href="x">A</a> &amp; B</td></tr>
<tr><td>2<td>"Two"<td>C
<tr><td rowspan="2">3</td><td>"Three"</td><td>D</td></tr>
<tr><td>"Four"</td><td>E</td></tr>
</tbody></table>
<table class="wikitable sortable"><tbody><tr><td></td><td><a href="//o.example/z">Five</a></td><td>F</td></tr></tbody></table>
<table class="wikitable sortable"><tr><td>9</td><td>no body</td><td>G</td></tr></table>
</body></html>"""


def frame(spark, *sources):
    return spark.createDataFrame([(i, "https://en.example.org/wiki/P", s) for i, s in enumerate(sources)], "page_id int, url string, html string")


def test_chart_rows(spark):
    rows = pages.chart_rows(frame(spark, CHART, "", "<table")).orderBy("table_no", "row_no").collect()
    assert [(r.year, r.place, r.name, r.artist, r.link) for r in rows] == [
        ("UNKNOWN", "1", "One more", "A & B", "https://en.example.org/wiki/One"),
        ("UNKNOWN", "2", "Two", "C", None),
        ("UNKNOWN", "3", "Three", "D", None),
        ("UNKNOWN", None, "Five", "F", "https://o.example/z"),
    ]
    titled = CHART.replace("Singles <i>x</i> of", "Top 30 singles of")
    assert {r.year for r in pages.chart_rows(frame(spark, titled)).collect()} == {"1970"}


WIKI = """<div class="mw-parser-output"><p>Won a <b>Grammy</b> award.</p><div><p>nested award</p></div>
<ul><li>honor one<ul><li>award two</li></ul></li><li>nothing</li><li>honor <i>one</i></li></ul>
<p>a wonder<p>award two</p>
<table class="wikitable"><tr><th>Award</th><td>Best</td></tr><tr></tr></table><table><tr><td>award plain</td></tr></table></div>
<p>award outside</p>"""


def test_award_blocks(spark):
    rows = pages.award_blocks(frame(spark, WIKI)).orderBy("layout", "block_no").collect()
    assert [(r.layout, r.text) for r in rows] == [
        (0, "honor one award two"),
        (0, "honor  one"),
        (0, "award two"),
        (1, "Won a  Grammy  award."),
        (1, "a wonder"),
        (2, "Award Best"),
    ]


def test_year_links(spark):
    nav = """<div class="navbox" aria-labelledby="Billboard_Year-End_Hot_100_singles_x"><div class="navbox-list"><ul>
    <li><a href="/wiki/1970"> 1970 </a></li><li><a href="/wiki/x">List</a></li><li><a>1971</a></li></ul></div></div>
    <ul><li><a href="/wiki/1999">1999</a></li></ul>"""
    rows = pages.year_links(frame(spark, nav)).collect()
    assert [(r.label, r.link) for r in rows] == [(" 1970 ", "https://en.example.org/wiki/1970")]
    assert pages.page_links(frame(spark, nav), everywhere=True).count() == 3


def test_deep_nesting_does_not_recurse():
    root = html.parse("<div>" * 20_000 + "x")
    assert root.texts() == ["x"]


MODERN = {
    "frameworkUpdates": {
        "entityBatchUpdate": {
            "mutations": [
                {"payload": {"commentEntityPayload": {"properties": {"commentId": "a", "content": {"content": "object"}, "likeCount": "3", "publishedTime": "1d"}, "author": {"displayName": "Ann"}}}},
                {"payload": {"commentEntityPayload": {"properties": {"commentId": "b", "content": "plain", "authorButtonA11y": "@bob"}, "author": {"displayName": ""}}}},
                {"payload": {"commentEntityPayload": {"properties": {}}}},
                {"payload": {"other": 1}},
                {"payload": {"commentEntityPayload": {"properties": {"commentId": "a", "content": "again"}}}},
                {"payload": {"commentEntityPayload": {"properties": {"content": "no id"}}}},
                {"payload": {"commentEntityPayload": {"properties": {"content": "no id"}}}},
            ]
        }
    }
}
LEGACY = {
    "onResponseReceivedEndpoints": [
        {"reloadContinuationItemsCommand": {"continuationItems": [{"commentThreadRenderer": {"comment": {"commentRenderer": {"commentId": "l1", "contentText": {"runs": [{"text": "x"}, {}, {"text": "y"}]}, "authorText": {"simpleText": "Lee"}, "publishedTimeText": {"simpleText": "2d"}}}}}]}},
        {"reloadContinuationItemsCommand": {"continuationItems": []}, "appendContinuationItemsAction": {"continuationItems": [{"commentRenderer": {"commentId": "b"}}, {"commentRenderer": {}}, {"x": 1}, {"commentRenderer": {"publishedTime": "3d"}}]}},
        {},
    ]
}


def test_payloads(spark):
    sources = [(0, json.dumps({**MODERN, **LEGACY})), (1, "{broken"), (2, json.dumps({"frameworkUpdates": None})), (3, None), (4, "[]")]
    df = spark.createDataFrame(sources, "page int, payload string")
    rows = comments.payload_comments(df, ["page"]).orderBy("idx").collect()
    assert [(r.comment_id, r.author, r.text, r.like_count, r.published_at) for r in rows] == [
        ("a", "Ann", "object", "3", "1d"),
        ("b", "@bob", "plain", None, None),
        (None, None, "no id", None, None),
        (None, None, "no id", None, None),
        ("l1", "Lee", "xy", None, "2d"),
        (None, None, "", None, "3d"),
    ]


def test_numbering_and_candidates(spark):
    df = spark.createDataFrame([("v", c, p, i) for c in (1, 2, 5) for p in (1, 2) for i in range(12)], "v string, c int, page int, idx int")
    picked = comments.pick_candidate(df, "v", "c")
    cut = comments.numbered(picked, ["v"], "page", 99).orderBy("position").collect()
    assert [(r.c, r.page, r.idx, r.position) for r in cut] == [(1, 1 + i // 12, i % 12, i + 1) for i in range(15)]


def test_embedded_json(spark):
    sources = [
        ('<script>var ytInitialData = {"k": 1};</script>', 1),
        ('<script>"ytInitialData" : {"k": {"k": 2}, "k": 3}\n;</script>', None),
        ('<script>window["ytInitialData"] = {"k": 4}; x()</script>', 4),
        ('ytInitialData = {bad};</script> window["ytInitialData"] = {"k": 5};', 5),
        ('{"k": 6}', 6),
        ("<p>none</p>", None),
        (None, None),
    ]
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(sources)], "i int, s string")
    got = df.select("i", F.try_variant_get(embedded_json(F.col("s")), "$.k", "int").alias("k")).orderBy("i").collect()
    assert [r.k for r in got][0] == 1 and [r.k for r in got][2:] == [k for _, k in sources][2:]


def test_page_rows_in_sql(spark):
    """The kind of rows gives the columns; pages without rows and NULL pages give none."""
    pages.register_page_rows(spark)
    chart = '<h1 id="firstHeading">Singles of 1999</h1><table class="wikitable sortable"><tbody><tr><td>1<td>"A"<td>B</tr></tbody></table>'
    made = spark.createDataFrame([(1, chart), (2, "<p>none</p>"), (3, None)], "page_id int, html string")
    rows = spark.sql("SELECT page_id, r.* FROM {made}, LATERAL page_rows(html, 'chart') AS r", made=made)
    assert [(r.page_id, r.title, r.name, r.artist) for r in rows.collect()] == [(1, "Singles of 1999", "A", "B")]
    assert spark.sql("SELECT r.* FROM {made}, LATERAL page_rows(html, 'blocks') AS r", made=made).columns == ["layout", "block_no", "text"]
    with pytest.raises(Exception, match="kind of rows"):
        spark.sql("SELECT r.* FROM {made}, LATERAL page_rows(html, 'other') AS r", made=made).collect()


def test_chart_pages_are_parsed_by_as_many_tasks_as_a_shuffle_has(spark):
    """One partition of pages, as of a small file."""
    one = frame(spark, "<p>x</p>").coalesce(1)
    rows = pages.chart_rows(one)
    assert "REPARTITION_BY_NUM" in rows._jdf.queryExecution().executedPlan().toString()
    assert pages.spread(one).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_parsed_rows_of_a_batch_leave_in_parts():
    pdf = pages.pd.DataFrame({"page_id": range(300), "url": "u", "html": "p"})
    parts = list(pages._mapper(["n"], lambda root: ((i,) for i in range(100)))([pdf]))
    assert sum(map(len, parts)) == 30_000 and max(map(len, parts)) <= pages._ROWS_AT_ONCE
    assert set(zip(*(c.tolist() for c in (parts[0]["page_id"], parts[0]["n"])))) == {(p, n) for p in range(20) for n in range(100)}
