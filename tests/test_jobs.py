from pyspark.sql import functions as F

from chartloom.plans import catalogue, incremental
from chartloom.plans.assemble import assemble
from chartloom.schemas import AUDIO_FIELDS, AUDIO_SONGS, AUDIO_STRUCT, AWARDS, COMMENTS, VIDEO_LINKS, audio_struct
from chartloom.session import new_workspace
from chartloom.sources.tables import read_published


def _base(spark, n=6):
    rows = [(i, f"Song {i % 4}", "Ann", "1970", str(i), None, f"t{i}" if i != 2 else None, i) for i in range(n)]
    shape = "ord bigint, name string, artist string, year string, place string, link string, spotify_track_id string, popularity bigint"
    df = spark.createDataFrame(rows, shape)
    for c, t in catalogue.LYRICS.items():
        df = df.withColumn(c, F.lit(None).cast(t))
    return df


def test_assemble_keeps_every_base_row(spark):
    """Duplicate keys and ids on all sides add and lose nothing; lists stay within the cap."""
    base = _base(spark)
    audio = spark.range(40).select(
        F.concat(F.lit("t"), (F.col("id") % 4).cast("string")).alias("spotify_track_id"),
        audio_struct({"tempo": F.col("id")}).alias("audio_metadata"), F.col("id").alias("ord"),
    )
    features = spark.createDataFrame([("t0", 0.1, 0), ("t0", 0.2, 1)], "spotify_track_id string, energy double, ord bigint")
    links = spark.createDataFrame([("v", None, None, "song 0", "ANN", "1970", 0)], VIDEO_LINKS + ", ord bigint")
    comments = spark.createDataFrame(
        [(None, "Song 1", "Ann", "other", f"c{i}", "a", "x", "1", None, i, i) for i in range(30)]
        + [(None, None, None, "v", "by id", "a", "x", "1", None, 1, 99)],
        COMMENTS + ", ord bigint",
    )
    awards = spark.createDataFrame([("song 3|ann", None, None, None, None, ["w", ""], 0)], AWARDS + ", ord bigint")
    out = assemble(base, audio, features, links, comments, awards, limit=99, keep=("ord",)).orderBy("ord").collect()
    assert [r.ord for r in out] == list(range(6))
    assert [r.audio_metadata and r.audio_metadata.tempo for r in out] == [36.0, 37.0, None, 39.0, None, None]
    assert [r.spotify_audio_features and r.spotify_audio_features.energy for r in out] == [0.2] + [None] * 5
    assert [r.youtube_id for r in out] == ["v", None, None, None, "v", None]
    assert [len(r.youtube_comments) for r in out] == [1, 15, 0, 0, 1, 15]
    assert [r.awards for r in out] == [[], [], [], ["w"], [], []]
    none = assemble(base, audio, features, links, comments, awards, limit=-1)
    assert {len(r.youtube_comments) for r in none.collect()} == {0}


def test_publish_next(spark):
    struct = F.when(F.col("ord") != 1, audio_struct({"tempo": F.col("ord")})).cast(AUDIO_STRUCT)
    records = _base(spark).withColumn("audio_metadata", struct).withColumn("lyrics", F.struct(F.lit("x").alias("text")))
    root = new_workspace(spark, "songs")
    assert sorted(r.ord for r in incremental.publish_next(records, root, 2).collect()) == [0, 1]
    assert sorted(r.ord for r in incremental.publish_next(records, root, 1).collect()) == [0, 1, 2]
    for _ in range(2):
        assert sorted(r.ord for r in incremental.publish_next(records, root, 9).collect()) == [0, 1, 2, 3]
    assert sorted(r.ord for r in incremental.publish_next(records, new_workspace(spark, "s"), 9, strict=True).collect()) == [0]
    assert read_published(spark, root, records.schema).count() == 4


def test_audio_queue(spark):
    half = spark.createDataFrame([(i, f"t{i}" if i else None) for i in range(6)], "ord bigint, spotify_track_id string")
    done = audio_struct({"length": F.when(F.col("ord") == 3, F.lit(1))})
    rows = half.withColumn("audio_metadata", F.when(F.col("ord") > 1, done))
    assert sorted(r.ord for r in incremental.audio_queue(rows, 0, 3).collect()) == [1, 2]
    assert sorted(r.ord for r in incremental.audio_queue(rows, 2, None).collect()) == [2, 4, 5]
    assert sorted(r.ord for r in incremental.audio_queue(rows, 0, 3, force=True).collect()) == [1, 2, 3]
    assert len(AUDIO_FIELDS) == 58 and "audio_metadata" in AUDIO_SONGS


def test_catalogue_and_lyrics(spark):
    chart = spark.createDataFrame(
        [(0, "A", "x", "1970", "1", None), (1, "B", "x", "UNKNOWN", "2", None), (2, None, "x", "1970", "3", None)],
        "ord bigint, name string, artist string, year string, place string, link string",
    )
    found = spark.createDataFrame([(0, "t0", 9, "a", "X")], "pos int, id string, popularity bigint, title string, artist string")
    root = new_workspace(spark, "ids")
    ids = catalogue.match_ids(chart, found, root)
    assert sorted((r.ord, r.year, r.spotify_track_id) for r in ids.collect()) == [(0, 1970, "t0"), (1, 0, None)]
    again = catalogue.match_ids(chart.filter("false"), found, root)
    assert again.count() == 2
    wide = catalogue.attach_features(ids, spark.createDataFrame([("t0", 0.5)], "id string, energy double"))
    assert wide.columns == ["ord", "year", "place", "name", "artist", "link", "spotify_track_id", "popularity", "energy"]
    report = catalogue.match_report(ids).first()
    assert (report.total, report.matched, report.rate) == (2, 1, 50.0)

    songs = ids.withColumn("genius_status", F.when(F.col("ord") == 1, "Success (Strict)")).withColumn("lyrics", F.lit("old"))
    strict = spark.createDataFrame([(0, "words", 1, None), (1, "never", 1, None)], "query_ord bigint, lyrics string, pageviews bigint, release_date string")
    hits = spark.createDataFrame([], "query_ord bigint, pos int, type string, id bigint, artist_names string, release_date_components struct<year:int>, pageviews bigint")
    details = spark.createDataFrame([], "id bigint, lyrics string, pageviews bigint, release_date string")
    done = catalogue.update_lyrics(songs, strict, hits, details, batch=5)
    assert sorted((r.ord, r.lyrics, r.genius_status, r.genius_pageviews) for r in done.collect()) == [
        (0, "words", "Success (Strict)", 1),
        (1, "old", "Success (Strict)", None),
    ]
