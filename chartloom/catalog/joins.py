"""Lookups and the flagship assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartloom.catalog import query
from chartloom.catalog.standins import (
    AUDIO,
    AWARDS,
    COMMENTS,
    LINKS,
    SONGS,
    audio_rows,
    award_rows,
    comment_rows,
    feature_rows,
    join_comments,
    link_rows,
    songs,
    table,
)
from chartloom.functions.text import joinable_key, track_key
from chartloom.operators import lookups
from chartloom.plans import assemble as job


def _key():
    return joinable_key(track_key(F.col("name"), F.col("artist")))


_TWO_KEYS = """by_id AS (
  SELECT youtube_id, string_agg(comment_id || '/' || coalesce(CAST(position AS VARCHAR), '-'), ';' ORDER BY rn) AS list FROM (
    SELECT *, row_number() OVER (PARTITION BY youtube_id
      ORDER BY coalesce(position, 0), l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn
    FROM comments WHERE youtube_id IS NOT NULL) WHERE rn <= 10 GROUP BY 1),
by_key AS (
  SELECT track_key, string_agg(comment_id || '/' || coalesce(CAST(position AS VARCHAR), '-'), ';' ORDER BY rn) AS list FROM (
    SELECT *, row_number() OVER (PARTITION BY track_key
      ORDER BY coalesce(position, 0), l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn
    FROM comments WHERE track_key IS NOT NULL) WHERE rn <= 10 GROUP BY 1)"""


def assembled(spark, sf_dir, keep=("ord",)):
    return job.assemble(
        songs(spark, sf_dir),
        audio_rows(spark, sf_dir),
        feature_rows(spark, sf_dir),
        link_rows(spark, sf_dir),
        comment_rows(spark, sf_dir),
        award_rows(spark, sf_dir),
        limit=10,
        keep=keep,
    )


@query(
    "assemble_dataset",
    f"""WITH {SONGS}, {AUDIO}, {LINKS}, {COMMENTS}, {AWARDS}, {_TWO_KEYS}
SELECT s.ord, s.name, s.artist, s.year, s.place AS "rank", s.link AS wikipedia_link, s.spotify_track_id, s.popularity,
  s.lyrics AS lyrics_text, s.genius_status AS lyrics_status, s.genius_pageviews AS lyrics_pageviews,
  CAST(a.l_quantity AS BIGINT) AS length, a.l_discount AS rms_mean, a.l_extendedprice AS tempo,
  c.c_acctbal AS energy, c.c_mktsegment AS mode, l.youtube_id, l.youtube_url,
  coalesce(i.list, k.list, '') AS comments, coalesce(w.awards, '') AS awards
FROM songs s
LEFT JOIN audio a ON s.spotify_track_id = 'T' || a.l_partkey
LEFT JOIN customer c ON s.spotify_track_id = 'T' || c.c_custkey
LEFT JOIN links l ON s.track_key = l.track_key
LEFT JOIN awards w ON s.track_key = w.track_key
LEFT JOIN by_id i ON l.youtube_id = i.youtube_id
LEFT JOIN by_key k ON s.track_key = k.track_key""",
)
def assemble_dataset(spark, sf_dir):
    return assembled(spark, sf_dir).select(
        "ord", "name", "artist", "year", "rank", "wikipedia_link", "spotify_track_id", "popularity",
        F.col("lyrics.text").alias("lyrics_text"),
        F.col("lyrics.status").alias("lyrics_status"),
        F.col("lyrics.pageviews").alias("lyrics_pageviews"),
        F.col("audio_metadata.length").alias("length"),
        F.col("audio_metadata.rms_mean").alias("rms_mean"),
        F.col("audio_metadata.tempo").alias("tempo"),
        F.col("spotify_audio_features.energy").alias("energy"),
        F.col("spotify_audio_features.mode").alias("mode"),
        "youtube_id", "youtube_url",
        join_comments().alias("comments"),
        F.array_join("awards", ";").alias("awards"),
    )


def with_audio(spark, sf_dir):
    """Records with only their audio struct attached: enough for the missing-field reports."""
    out = lookups.attach_struct(
        songs(spark, sf_dir), audio_rows(spark, sf_dir), "spotify_track_id", ["ord"],
        F.col("audio_metadata"), "audio_metadata", ["ord"],
    )
    return job.canonical(out, keep=("ord",))


@query(
    "left_join_struct",
    f"""WITH {SONGS}, {AUDIO}
SELECT s.ord, CAST(a.l_quantity AS BIGINT) AS length, a.l_discount AS rms_mean, a.l_extendedprice AS tempo
FROM songs s LEFT JOIN audio a ON s.spotify_track_id = 'T' || a.l_partkey""",
)
def left_join_struct(spark, sf_dir):
    out = lookups.attach_struct(
        songs(spark, sf_dir), audio_rows(spark, sf_dir), "spotify_track_id", ["ord"],
        F.col("audio_metadata"), "audio_metadata", ["ord"],
    )
    return out.select("ord", "audio_metadata.length", "audio_metadata.rms_mean", "audio_metadata.tempo")


@query(
    "dynamic_struct",
    """SELECT o_orderkey, o_custkey, c_name, c_nationkey, c_acctbal FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def dynamic_struct(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    out = lookups.attach_struct(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
        customers.withColumnRenamed("c_custkey", "o_custkey"),
        "o_custkey", ["o_custkey"],
        lookups.other_columns(customers, ("c_custkey", "c_mktsegment")), "features", ["o_orderkey"],
    )
    return out.select("o_orderkey", "o_custkey", "features.*")


@query(
    "link_join",
    f"""WITH {SONGS}, {LINKS}
SELECT s.ord, l.youtube_id, l.youtube_url, coalesce(l.has_candidates, false) AS has_candidates
FROM songs s LEFT JOIN links l ON s.track_key = l.track_key""",
)
def link_join(spark, sf_dir):
    out = lookups.attach_links(songs(spark, sf_dir), job.link_side(link_rows(spark, sf_dir)), _key(), ["ord"])
    has = F.coalesce(F.size("youtube_candidates") > 0, F.lit(False)).alias("has_candidates")
    return out.select("ord", "youtube_id", "youtube_url", has)


@query(
    "two_key_lookup",
    f"""WITH {SONGS}, {COMMENTS}, {_TWO_KEYS}
SELECT s.ord, coalesce(i.list, k.list, '') AS comments FROM songs s
LEFT JOIN by_id i ON i.youtube_id = 'V' || s.ord LEFT JOIN by_key k ON s.track_key = k.track_key""",
)
def two_key_lookup(spark, sf_dir):
    base = songs(spark, sf_dir).select(
        "ord", F.concat(F.lit("V"), F.col("ord").cast("string")).alias("youtube_id"), _key().alias("probe")
    )
    out = lookups.list_by_two_keys(
        base, job.comment_rows(comment_rows(spark, sf_dir)), ("youtube_id", "track_key"),
        (F.col("youtube_id"), F.col("probe")),
        [F.coalesce(F.col("position"), F.lit(0)), F.col("ord")], 10,
        [F.col("comment_id"), F.col("position")], "youtube_comments", ["ord"],
    )
    return out.select("ord", join_comments().alias("comments"))


@query(
    "array_default_join",
    f"""WITH {SONGS}, {AWARDS}
SELECT s.ord, coalesce(w.awards, '') AS awards, CASE WHEN w.awards IS NULL THEN 0 ELSE 2 END AS n_awards
FROM songs s LEFT JOIN awards w ON s.track_key = w.track_key""",
)
def array_default_join(spark, sf_dir):
    out = lookups.attach_lists(songs(spark, sf_dir), job.award_side(award_rows(spark, sf_dir)), _key(), "track_key", "awards", ["ord"])
    return out.select("ord", F.array_join("awards", ";").alias("awards"), F.size("awards").alias("n_awards"))


@query(
    "left_join_rename",
    """SELECT o_orderkey, o_orderstatus, o_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def left_join_rename(spark, sf_dir):
    return lookups.join_renamed(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), "o_custkey", "c_custkey",
        ["o_orderkey", "o_orderstatus", "o_custkey"],
    )


@query(
    "write_back",
    """SELECT d.doc_id, d.lang, CASE WHEN l.doc_id IS NULL THEN d.source WHEN l.toxic = 1 THEN NULL
  ELSE 'quality ' || l.quality END AS source
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def write_back(spark, sf_dir):
    results = table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("toxic") == 0, F.concat(F.lit("quality "), F.col("quality").cast("string"))).alias("source")
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return lookups.write_back(docs, results, "doc_id", ["source"], "doc_id")
