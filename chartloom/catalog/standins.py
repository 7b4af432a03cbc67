"""The given tables in the role of the inputs, in Spark and in SQL.

No music data is supplied, so parts play the songs, line items the audio rows
and comments, customers the catalogue features, orders the awards.  Roles use
whole tables; where an input may be absent, an attribute of the row decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.schemas import audio_struct
from chartloom.session import tune

LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_id(prefix: str, c) -> F.Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def songs(spark, sf_dir) -> DataFrame:
    kind = F.col("p_type")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ord"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("artist"),
        (F.col("p_size") + 1946).cast("string").alias("year"),
        F.col("p_size").cast("string").alias("place"),
        F.when(kind != "ECONOMY", F.concat(F.lit("/wiki/"), F.col("p_name"))).alias("link"),
        F.when(kind != "PROMO", text_id("T", "p_partkey")).alias("spotify_track_id"),
        F.floor("p_retailprice").cast("bigint").alias("popularity"),
        F.when(kind.isin("SMALL", "MEDIUM"), F.concat_ws(" ", "p_type", "p_name")).alias("lyrics"),
        F.when(kind == "SMALL", "Success (Strict)")
        .when(kind == "MEDIUM", "Success (Heuristic)")
        .when(kind == "LARGE", "Lyrics Empty (Artist-Fuzz)")
        .when(kind == "PROMO", "Song Not Found")
        .when(kind == "STANDARD", "Error (Timeout)")
        .alias("genius_status"),
        (F.col("p_size") * 10).cast("bigint").alias("genius_pageviews"),
        F.lit(None).cast("string").alias("genius_release_date"),
    )


SONGS = """songs AS (
  SELECT p_partkey AS ord, p_name AS name, p_brand AS artist, CAST(p_size + 1946 AS VARCHAR) AS year,
    CAST(p_size AS VARCHAR) AS place,
    CASE WHEN p_type <> 'ECONOMY' THEN '/wiki/' || p_name END AS link,
    CASE WHEN p_type <> 'PROMO' THEN 'T' || p_partkey END AS spotify_track_id,
    CAST(floor(p_retailprice) AS BIGINT) AS popularity,
    CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN p_type || ' ' || p_name END AS lyrics,
    CASE p_type WHEN 'SMALL' THEN 'Success (Strict)' WHEN 'MEDIUM' THEN 'Success (Heuristic)'
      WHEN 'LARGE' THEN 'Lyrics Empty (Artist-Fuzz)' WHEN 'PROMO' THEN 'Song Not Found'
      WHEN 'STANDARD' THEN 'Error (Timeout)' END AS genius_status,
    CAST(p_size * 10 AS BIGINT) AS genius_pageviews, lower(p_name || '|' || p_brand) AS track_key
  FROM part)"""


def line_ord() -> F.Column:
    return F.struct(*LINE_ORDER).alias("ord")


def audio_rows(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        text_id("T", "l_partkey").alias("spotify_track_id"),
        audio_struct(
            {"length": F.col("l_quantity"), "rms_mean": F.col("l_discount"), "tempo": F.col("l_extendedprice")}
        ).alias("audio_metadata"),
        line_ord(),
    )


def feature_rows(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        text_id("T", "c_custkey").alias("spotify_track_id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("energy"),
        F.col("c_mktsegment").alias("mode"),
        F.col("c_custkey").alias("ord"),
    )


def link_rows(spark, sf_dir) -> DataFrame:
    vid = F.when(F.col("p_size") > 5, text_id("V", "p_partkey"))
    return table(spark, sf_dir, "part").select(
        vid.alias("youtube_id"),
        F.when(F.col("p_type") == "SMALL", F.concat(F.lit("https://v.example/"), F.col("p_name"))).alias("youtube_url"),
        F.when(
            F.col("p_type") != "LARGE",
            F.array(F.struct(vid.alias("youtube_id"), F.lit(None).cast("string").alias("youtube_url"))),
        ).alias("youtube_candidates"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("artist"),
        F.col("p_partkey").alias("ord"),
    )


LINKS = """links AS (
  SELECT track_key, youtube_id, youtube_url, has_candidates FROM (
    SELECT lower(p_name || '|' || p_brand) AS track_key,
      CASE WHEN p_size > 5 THEN 'V' || p_partkey END AS youtube_id,
      CASE WHEN p_type = 'SMALL' THEN 'https://v.example/' || p_name
        WHEN p_size > 5 THEN 'https://www.youtube.com/watch?v=V' || p_partkey END AS youtube_url,
      p_type <> 'LARGE' AS has_candidates,
      row_number() OVER (PARTITION BY lower(p_name || '|' || p_brand) ORDER BY p_partkey DESC) AS rn
    FROM part) WHERE rn = 1)"""


def comment_rows(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    titles = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("track_name"), F.col("p_brand").alias("artist")
    )
    return lines.join(titles, lines["l_partkey"] == titles["p_partkey"], "left").select(
        F.lit(None).cast("string").alias("track_key"),
        "track_name",
        "artist",
        F.when(F.col("l_linestatus") == "O", text_id("V", "l_partkey")).alias("youtube_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey").alias("comment_id"),
        text_id("S", "l_suppkey").alias("author"),
        F.col("l_returnflag").alias("text"),
        F.col("l_quantity").cast("int").cast("string").alias("like_count"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("published_at"),
        F.when(F.col("l_linenumber") < 7, F.col("l_linenumber")).alias("position"),
        line_ord(),
    )


COMMENTS = """comments AS (
  SELECT lower(p_name || '|' || p_brand) AS track_key,
    CASE WHEN l_linestatus = 'O' THEN 'V' || l_partkey END AS youtube_id,
    l_orderkey || '-' || l_linenumber || '-' || l_suppkey AS comment_id,
    CASE WHEN l_linenumber < 7 THEN l_linenumber END AS position,
    l_returnflag AS text, l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"""


def award_rows(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    titles = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("track_name"), F.col("p_brand").alias("artist")
    )
    return orders.join(titles, orders["o_custkey"] == titles["p_partkey"]).select(
        F.lit(None).cast("string").alias("track_key"),
        "track_name",
        "artist",
        F.array("o_orderpriority", F.lit(""), "o_orderstatus").alias("awards"),
        F.col("o_orderkey").alias("ord"),
    )


AWARDS = """awards AS (
  SELECT track_key, awards FROM (
    SELECT lower(p_name || '|' || p_brand) AS track_key, o_orderpriority || ';' || o_orderstatus AS awards,
      row_number() OVER (PARTITION BY lower(p_name || '|' || p_brand) ORDER BY o_orderkey DESC) AS rn
    FROM orders JOIN part ON o_custkey = p_partkey) WHERE rn = 1)"""

AUDIO = """audio AS (
  SELECT l_partkey, l_quantity, l_discount, l_extendedprice FROM (
    SELECT *, row_number() OVER (PARTITION BY l_partkey
      ORDER BY l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) AS rn FROM lineitem) WHERE rn = 1)"""


def join_comments(c: str = "youtube_comments") -> F.Column:
    return F.array_join(
        F.transform(c, lambda e: F.concat_ws("/", e["comment_id"], F.coalesce(e["position"].cast("string"), F.lit("-")))),
        ";",
    )
