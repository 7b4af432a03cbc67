import collections
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from chartloom.functions.text import track_key
from chartloom.functions.values import drop_empty
from chartloom.operators import changes, keyed, lookups, ordering, reports
from chartloom.plans import assemble, incremental
from chartloom.schemas import audio_struct

random.seed(7)
# One key holds a third of the rows.
ROWS = [(i, "hot" if random.random() < 0.34 else f"k{random.randrange(40)}", random.randrange(5)) for i in range(600)]


@pytest.fixture(scope="module")
def rows(spark):
    shuffled = random.sample(ROWS, len(ROWS))
    return spark.createDataFrame(shuffled, "ord bigint, k string, v int").repartition(7).cache()


def by_key():
    out = defaultdict(list)
    for r in ROWS:
        out[r[1]].append(r)
    return out


def test_last_and_first(rows):
    groups = by_key()
    assert {r.k: r.ord for r in keyed.last_wins(rows, "k", "ord").collect()} == {k: g[-1][0] for k, g in groups.items()}
    assert {r.k: r.ord for r in keyed.first_wins(rows, "k", ["ord"]).collect()} == {k: g[0][0] for k, g in groups.items()}


def test_top_n_and_collect(rows):
    want = {k: sorted((g[2], g[0]) for g in group)[:4] for k, group in by_key().items()}
    got = defaultdict(list)
    for r in keyed.top_n(rows, "k", ["v", "ord"], 4).collect():
        got[r.k].append((r.v, r.ord))
    assert {k: sorted(x) for k, x in got.items()} == want
    lists = keyed.collect_top(rows, "k", ["v", "ord"], 4, [F.col("v"), F.col("ord")], "l").collect()
    assert {r.k: [tuple(x) for x in r.l] for r in lists} == want


def test_argmax_takes_first_on_tie(rows):
    best = keyed.argmax_first(rows, "k", F.col("v"), "ord")
    want = {k: min((-g[2], g[0]) for g in group)[1] for k, group in by_key().items()}
    assert {r.k: r.ord for r in best.collect()} == want


def test_positions(rows):
    placed = ordering.add_position(rows, "ord", into="p").collect()
    assert sorted((r.p, r.ord) for r in placed) == [(i + 1, i) for i in range(600)]
    per_key = ordering.add_position(rows, "ord", ["k"], into="p").collect()
    want = {(k, g[0]): i + 1 for k, group in by_key().items() for i, g in enumerate(group)}
    assert {(r.k, r.ord): r.p for r in per_key} == want


def test_positions_keep_null_keys(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "ord bigint, k string")
    assert sorted((r.ord, r.p) for r in ordering.add_position(df, "ord", ["k"], into="p").collect()) == [(1, 1), (2, 2), (3, 1)]


def test_first_rows(rows):
    assert sorted(r.ord for r in ordering.first_rows(rows, "ord", 25).collect()) == list(range(25))
    assert ordering.first_rows(rows, "ord", 0).count() == 0


def test_first_rows_of_a_struct_a_sparse_and_an_equal_order(spark):
    df = spark.range(120_000).select("id", F.struct((-F.col("id")).alias("a"), "id").alias("s"), (F.col("id") * 10**9).alias("far"), F.lit(1).alias("same"))
    assert ordering.first_rows(df, "s", 110_000).agg(F.min("id"), F.count("id")).first() == (10_000, 110_000)
    assert ordering.first_rows(df, "far", 3).agg(F.max("id")).first()[0] == 2
    assert ordering.first_rows(df, "same", 50_000).select("id").distinct().count() == 50_000


def test_slices(rows):
    assert sorted(r.ord for r in ordering.slice_rows(rows, "ord", 10, 5).collect()) == list(range(10, 15))
    assert ordering.slice_rows(rows, "ord", 10, 0).count() == 590
    kept = ordering.filter_then_limit(rows, "ord", F.col("k") == "hot", 100, 5).collect()
    assert [r.ord for r in kept] == [r[0] for r in ROWS[100:] if r[1] == "hot"][:5]


def test_first_candidate_with_rows(spark):
    df = spark.createDataFrame([("a", 0, 0), ("a", 2, 3), ("a", 3, 1), ("b", 4, 9), ("c", 1, 0)], "q string, i int, n int")
    assert [tuple(r) for r in keyed.first_with_rows(df, "q", "i", F.col("n")).collect()] == [("a", 2, 3)]


def test_complete_prefix(spark):
    df = spark.createDataFrame([(0, True), (1, True), (2, None), (3, True)], "ord bigint, ok boolean")
    assert sorted(r.ord for r in keyed.complete_prefix(df, "ord", F.col("ok")).collect()) == [0, 1]
    assert keyed.complete_prefix(df.filter("ok"), "ord", F.col("ok")).count() == 3


def test_struct_lookup(spark):
    """Last record wins; NULL, '' and 'nan' ids; NULL struct skipped; old value kept without a match."""
    base = spark.createDataFrame(
        [(0, "a", "old"), (1, "b", "old"), (2, None, "old"), (3, "", None), (4, "nan", None)], "ord bigint, id string, v string"
    )
    records = spark.createDataFrame(
        [("a", "x1", 1), ("a", "x2", 3), ("a", "x3", 2), ("a", None, 9), (None, "null", 4), ("", "empty", 5)],
        "id string, value string, ord bigint",
    ).repartition(3)
    out = lookups.attach_struct(base, records, "id", ["ord"], F.col("value"), "v", ["ord"])
    assert sorted(tuple(r) for r in out.select("ord", "id", "v").collect()) == [
        (0, "a", "x2"), (1, "b", "old"), (2, None, "old"), (3, "", None), (4, "nan", None),
    ]


def test_lookup_null_keys_are_spread(spark):
    keys = spark.range(1000).select(lookups.probe_key(F.lit(None).cast("string"), F.col("id")).alias("k"))
    assert keys.distinct().count() > 500
    assert keys.filter(F.col("k").startswith("=")).count() == 0


def test_link_lookup(spark):
    base = spark.createDataFrame(
        [(0, "A", "x", None, None), (1, "A ", "X", "own", ""), (2, "", None, None, None)],
        "ord bigint, name string, artist string, youtube_id string, youtube_url string",
    )
    key = assemble.joinable_key(track_key(F.col("name"), F.col("artist")))
    shape = "youtube_id string, youtube_url string, youtube_candidates array<struct<youtube_id:string,youtube_url:string>>, name string, artist string, ord bigint"
    links = spark.createDataFrame(
        [("v1", "", [("v1", "u")], "a", "x", 1), ("v2", None, [], "a", "x", 2), ("blank", None, [], " ", "", 3)], shape
    )
    out = lookups.attach_links(base, assemble.link_side(links), key, ["ord"]).orderBy("ord").collect()
    assert [(r.youtube_id, r.youtube_url) for r in out] == [
        ("v2", "https://www.youtube.com/watch?v=v2"),
        ("own", "https://www.youtube.com/watch?v=v2"),
        (None, None),
    ]


def test_two_keys(spark):
    """Id first, then key; NULL position sorts as 0; more entries than the limit; no match."""
    base = spark.createDataFrame([(0, "v", "k1"), (1, "w", "k2"), (2, None, "k9"), (3, None, None)], "ord bigint, id string, key string")
    rows = [("v", "k1", f"c{i}", i + 1, i) for i in range(20)] + [("v", "k1", "zero", None, 99), ("u", "k2", "by key", 1, 100), (None, None, "lost", 1, 101)]
    entries = spark.createDataFrame(random.sample(rows, len(rows)), "id string, key string, c string, position int, ord bigint")
    order = [F.coalesce(F.col("position"), F.lit(0)), F.col("ord")]
    out = lookups.list_by_two_keys(base, entries, ("id", "key"), (F.col("id"), F.col("key")), order, 15, [F.col("c")], "l", ["ord"])
    got = {r.ord: [e.c for e in r.l] for r in out.collect()}
    assert got == {0: ["zero"] + [f"c{i}" for i in range(14)], 1: ["by key"], 2: [], 3: []}


def test_award_side(spark):
    awards = spark.createDataFrame(
        [(None, "A", "x", ["w", "", None], 1), ("a|x", "other", "y", ["last"], 2), (None, "", "", ["blank"], 3), ("b|", None, None, None, 4)],
        "track_key string, track_name string, artist string, awards array<string>, ord bigint",
    )
    assert sorted(tuple(r) for r in assemble.award_side(awards).collect()) == [("a|x", ["last"]), ("b|", [])]
    assert awards.select(drop_empty(F.col("awards")).alias("a")).first().a == ["w"]


def test_write_back(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "row int, v string")
    results = spark.createDataFrame([(1, "first", 5), (1, None, 7), (3, "z", 6)], "row int, v string, n int")
    out = lookups.write_back(base, results, "row", ["v", "n"], "n").orderBy("row").collect()
    assert [tuple(r) for r in out] == [(1, None, 7), (2, "b", None), (3, "z", 6)]


def test_join_renamed(spark):
    base = spark.createDataFrame([(1, "a"), (2, None)], "n int, spotify_track_id string")
    side = spark.createDataFrame([("a", 0.5)], "id string, energy double")
    out = lookups.join_renamed(base, side, "spotify_track_id", "id", ["spotify_track_id", "n"])
    assert out.columns == ["spotify_track_id", "n", "energy"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == [("a", 1, 0.5), (None, 2, None)]


def test_upsert_is_idempotent_and_ordered(spark):
    old = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old"), ("a", 3, "later")], "k string, ord bigint, v string")
    new = spark.createDataFrame([("b", 1, "n1"), ("b", 2, "n2"), ("z", 0, "n3")], "k string, ord bigint, v string")
    once = changes.upsert(old, new, "k", "ord")
    want = {"a": "later", "b": "n2", "z": "n3"}
    assert {r.k: r.v for r in once.collect()} == want
    assert {r.k: r.v for r in changes.upsert(once, new, "k", "ord").collect()} == want
    base = spark.createDataFrame([("b", 0), ("a", 1), ("b", 5)], "k string, ord bigint")
    placed = changes.upsert_in_order(old, new, "k", "ord", ordering.order_map(base, "k", "ord"), F.lit(99))
    assert [r.k for r in placed.orderBy("base_ord").collect()] == ["a", "b", "z"]


def test_delete_on_either_key(spark):
    rows = spark.createDataFrame([("v1", "k1", 1), ("v2", "k1", 2), (None, "k3", 3), ("v4", None, 4), (None, None, 5)], "id string, key string, n int")
    gone = spark.createDataFrame([("v4", "k1", 0), (None, None, 0), ("", "", 0)], "id string, key string, n int")
    assert sorted(r.n for r in changes.delete_matching(rows, gone, ["id", "key"]).collect()) == [3, 5]
    assert changes.replace_matching(rows, gone, ["id", "key"]).count() == 5


def test_append_new(spark):
    published = spark.createDataFrame([("a", 0)], "k string, ord bigint")
    new = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4), ("d", 5)], "k string, ord bigint")
    for room, want in ((0, []), (2, [2, 4]), (9, [2, 4, 5]), (-1, [])):
        got = changes.append_new(published, new, "k", "ord", room).collect()
        assert sorted(r.ord for r in got) == sorted([0, *want])


def test_dedup_keeps_rows_without_id(spark):
    df = spark.createDataFrame([("p", "a", 0), ("p", "a", 1), ("p", None, 2), ("p", None, 3), ("q", "a", 4)], "g string, id string, i int")
    assert sorted(r.i for r in changes.dedup_with_id(df, ["g"], "id", ["i"]).collect()) == [0, 2, 3, 4]


def test_reports(spark):
    df = spark.createDataFrame([(2000, "x"), (2000, None), (2001, "y"), (None, "x")], "year int, c string")
    tab = {r.year: tuple(r)[1:] for r in reports.crosstab(df, "year", "c", ["x", "z"]).collect()}
    assert tab == {2000: (1, 0, 1), 2001: (0, 0, 1)}
    assert {r.c: r.n for r in reports.value_counts(df, "c", keep_null=True).collect()} == {"x": 2, "y": 1, None: 1}
    assert [tuple(r) for r in reports.top_values(df, "c", 1).collect()] == [("x", 2)]
    assert {r.column_name: r.n_null for r in reports.null_counts(df).collect()} == {"year": 1, "c": 1}
    assert df.filter("false").agg(reports.rate(F.col("c") == "x").alias("r")).first().r is None


def test_batches(spark):
    ids = [f"id{i % 130}" for i in range(400)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "ord bigint, id string").repartition(5)
    got = {r.batch: r.ids for r in reports.id_batches(df, "id", "ord", 50).collect()}
    assert got == {b: [f"id{i}" for i in range(b * 50, min(b * 50 + 50, 130))] for b in range(3)}


def test_next_target(spark):
    """Targets of 0, some, and beyond the base; strict stops at the first gap."""
    struct = audio_struct({"tempo": F.col("tempo")})
    raw = spark.createDataFrame(
        [(0, "a", "x", "t", 1.0), (1, "A ", "X", "t", 1.0), (2, "b", "x", "t", 1.0), (3, "c", "x", None, 1.0), (4, "d", "x", "t", None)],
        "ord bigint, name string, artist string, spotify_track_id string, tempo double",
    )
    rows = raw.withColumn("audio_metadata", struct).withColumn("lyrics", F.struct(F.lit("t").alias("text")))
    for current, more, want in ((0, 0, []), (1, 1, [0, 2]), (2, 9, [0, 2, 3, 4])):
        assert sorted(r.ord for r in incremental.next_target(rows, current, more).collect()) == want
    assert sorted(r.ord for r in incremental.next_target(rows, 0, 9, strict=True).collect()) == [0, 2]
    lines = {r.ord: r.line for r in incremental.incomplete_report(rows).collect()}
    assert lines == {3: "c - x: missing spotify_track_id", 4: "d - x: missing audio_metadata"}


@pytest.mark.parametrize("n", [1, 97, 9_000, 29_999])
def test_first_rows_against_sorting(spark, n):
    """NULL orders first, ties, equal rows and a map column, beyond what is collected."""
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(300)]), rng.randint(0, 3), {"a": rng.randint(0, 2)}) for _ in range(30_000)]
    got = ordering.first_rows(spark.createDataFrame(rows, "o int, x int, m map<string,int>").repartition(7), "o", n).collect()
    least = sorted((-1 if o is None else o) for o, _, _ in rows)[:n]
    assert sorted(-1 if r.o is None else r.o for r in got) == least
    held = collections.Counter((o, x, m["a"]) for o, x, m in rows)
    assert not collections.Counter((r.o, r.x, r.m["a"]) for r in got) - held


def test_first_rows_sorts_and_exchanges_nothing(spark):
    out = ordering.first_rows(spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet"), "l_orderkey", 7_000)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in text and "Sort" not in text and "LessThanOrEqual(l_orderkey" in text
