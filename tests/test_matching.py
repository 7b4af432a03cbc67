from pyspark.sql import functions as F

from chartloom.operators import matching, sourcing


def test_cascade(spark):
    base = spark.createDataFrame(
        [(0, "Hey Jude", "The Beatles"), (1, "hey jude - Live", "Beatles The"), (2, "Nope", "x"), (3, "", "")],
        "ord bigint, name string, artist string",
    )
    catalogue = spark.createDataFrame(
        [(5, "t5", 1, "HEY JUDE", "the beatles"), (2, "t2", 2, "Hey Jude (Remaster)", "The Beatles"), (9, "t9", 3, "hey jude", "The Beatles")],
        "pos int, id string, popularity bigint, title string, artist string",
    ).repartition(3)
    got = {r.ord: (r.spotify_track_id, r.match_method) for r in matching.cascade_match(base, catalogue, "ord").collect()}
    assert got == {0: ("t5", "strict"), 1: ("t2", "loose"), 2: (None, None), 3: (None, None)}


def test_page_pick(spark):
    queries = spark.createDataFrame([(1, "Hello", "Ann"), (2, "Zzz", "Q")], "query_ord bigint, name string, artist string")
    hits = spark.createDataFrame(
        [(1, 0, "Hello", ""), (1, 1, "Hello (song)", "by Ann"), (1, 2, "Hello (song)", "Ann again"), (2, 0, "No match", ""), (2, 1, "Other", "")],
        "query_ord bigint, pos int, title string, snippet string",
    )
    got = {r.query_ord: (r.pos, r.score, r.link) for r in matching.score_pages(queries, hits).collect()}
    assert got[1] == (1, 6.0, "https://en.wikipedia.org/wiki/Hello_%28song%29")
    assert got[2] == (0, 0.0, "https://en.wikipedia.org/wiki/No_match")


HITS = "query_ord bigint, pos int, type string, id bigint, artist_names string, release_date_components struct<year:int>, pageviews bigint"


def test_resolution(spark):
    artists = ["Solo Act", "red ring", "abcdefghij", "Zed", "Zed", "Zed", "Nobody", "Zed", "Zed"]
    queries = spark.createDataFrame([(i, "n", a, 2000) for i, a in enumerate(artists)], "query_ord bigint, name string, artist string, year int")
    strict = spark.createDataFrame([(0, "words", 3, "2001"), (8, None, 1, None)], "query_ord bigint, lyrics string, pageviews bigint, release_date string")
    y = lambda n: None if n is None else (n,)
    hits = spark.createDataFrame(
        [
            (1, 0, "song", 10, "red ring (live)", y(1900), 1), (1, 1, "song", 11, "red ring", y(2000), 9),
            # 70 exactly: seven of ten letters shared, not above the bar; no year in the window.
            (2, 0, "song", 20, "abcdefgxyz", y(1990), 5),
            (3, 0, "song", 30, "qqq", y(2005), None), (3, 1, "song", 31, "qqq", y(1996), 7), (3, 2, "song", 32, "qqq", y(2004), 7),
            (4, 0, "song", 40, "qqq", y(2006), 7), (4, 1, "song", 41, "qqq", None, 7),
            (5, 0, "song", 50, "qqq", y(2005), None),
            (6, 0, "album", 60, "Nobody", y(2000), 7),
        ],
        HITS,
    ).repartition(3)
    details = spark.createDataFrame([(10, "found", 100, "d"), (31, None, 5, None)], "id bigint, lyrics string, pageviews bigint, release_date string")
    got = {r.query_ord: (r.genius_status, r.lyrics) for r in matching.resolve(queries, strict, hits, details).collect()}
    assert got == {
        0: ("Success (Strict)", "words"),
        1: ("Success (Artist-Fuzz)", "found"),
        2: ("Ambiguous Match (No Year)", None),
        3: ("Lyrics Empty (Heuristic)", None),
        4: ("Ambiguous Match (No Year)", None),
        5: ("Error (Code) (Heuristic)", None),
        6: ("Song Not Found", None),
        7: ("Song Not Found", None),
        8: ("Lyrics Empty (Strict)", None),
    }


def test_preview_or_search(spark):
    cases = [
        ("u", "m", None, "s", "n", None), ("u", None, "404", "s", "n", None), ("u", None, None, "s", None, "gone"),
        ("u", None, "404", "s", None, "gone"), (None, None, None, "s", None, "gone"), ("", None, None, "s", "n", None),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, pu string, pv string, pe string, su string, sv string, se string")
    out = sourcing.preview_or_search(df, *[F.col(c) for c in ("pu", "pv", "pe", "su", "sv", "se")]).orderBy("i").collect()
    assert [(r.audio_metadata, r.audio_metadata_status, r.audio_preview_url, r.audio_metadata_source) for r in out] == [
        ("m", "ok (preview)", "u", "spotify_preview"),
        ("n", "ok (youtube)", "s", "youtube_search"),
        (None, "empty audio from preview", None, None),
        (None, "preview error: 404", None, None),
        (None, "error: gone", None, None),
        ("n", "ok (youtube)", "s", "youtube_search"),
    ]


def test_link_reuse(spark):
    shape = "name string, artist string, link string, youtube_url string, audio_metadata_source string, audio_preview_url string"
    df = spark.createDataFrame(
        [("a", "x", None, "u?v=abcdef", None, None), ("b", "x", "L", "", "YOUTUBE_SEARCH", "p?v=ghijkl"), ("c", "x", "", None, "other", "p?v=ghijkl"), ("", "x", "L", "u?v=abcdef", None, None)],
        shape,
    )
    found = F.array(F.struct(F.lit("zz").alias("youtube_id"), F.lit("").alias("youtube_url")))
    got = {r.name: (r.youtube_id, r.youtube_url) for r in sourcing.reuse_video_link(df, found).collect()}
    assert got == {"a": ("abcdef", "u?v=abcdef"), "b": ("ghijkl", "p?v=ghijkl"), "c": ("zz", "https://www.youtube.com/watch?v=zz")}
    forced = {r.youtube_id for r in sourcing.reuse_video_link(df, found, force=True).collect()}
    assert forced == {"zz"}
    none = F.lit(None).cast("string")
    assert {r.name: r.link for r in sourcing.reuse_page_link(df, none).collect()} == {"b": "L"}
    assert {r.link for r in sourcing.reuse_page_link(df, F.lit("S"), force=True).collect()} == {"S"}
