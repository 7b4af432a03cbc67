"""Chart rows to catalogue ids and features, and lyrics from captured hits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.values import needs_work, to_int_or_zero
from chartloom.operators.lookups import join_renamed, write_back
from chartloom.operators.matching import cascade_match, resolve
from chartloom.operators.ordering import filter_then_limit
from chartloom.operators.reports import rate
from chartloom.schemas import CATALOGUE_KEY_COLUMNS, with_columns
from chartloom.sources.tables import stage

LYRICS = {
    "lyrics": "string",
    "genius_status": "string",
    "genius_pageviews": "bigint",
    "genius_release_date": "string",
}


def match_ids(chart: DataFrame, catalogue: DataFrame, root: str) -> DataFrame:
    """Chart rows with catalogue id and popularity, kept as a stage table at ``root``.

    Rows without a name or artist go; a year that is no number becomes 0.  When
    the stage is there already the search is skipped.
    """
    clean = chart.na.drop(subset=["name", "artist"]).withColumn("year", to_int_or_zero(F.col("year")))
    return stage(chart.sparkSession, root, lambda: cascade_match(clean, catalogue, "ord").drop("match_method"))


def attach_features(matched: DataFrame, features: DataFrame) -> DataFrame:
    """Feature columns by catalogue id, key columns first."""
    return join_renamed(matched, features, "spotify_track_id", "id", ["ord", *CATALOGUE_KEY_COLUMNS])


def match_report(matched: DataFrame) -> DataFrame:
    hit = F.col("spotify_track_id").isNotNull()
    return matched.agg(F.count(F.lit(1)).alias("total"), F.count_if(hit).alias("matched"), F.round(rate(hit), 2).alias("rate"))


def update_lyrics(songs: DataFrame, strict: DataFrame, hits: DataFrame, details: DataFrame, batch: int | None = None) -> DataFrame:
    """Resolve the songs without a settled status and write the results back by row.

    ``strict``, ``hits`` and ``details`` are captured responses keyed by the
    songs' ``ord``.
    """
    songs = with_columns(songs, LYRICS)
    queue = filter_then_limit(songs, "ord", needs_work(F.col("genius_status")), limit=batch)
    asked = queue.select(F.col("ord").alias("query_ord"), "name", "artist", F.col("year").try_cast("int").alias("year"))
    results = resolve(asked, strict, hits, details).withColumnRenamed("query_ord", "ord")
    return write_back(songs, results, "ord", list(LYRICS), "ord")
