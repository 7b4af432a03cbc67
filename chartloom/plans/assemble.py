"""The flagship job: base songs joined to five enrichments, one record each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.text import first_nonempty, joinable_key, track_key, watch_url
from chartloom.functions.values import comment_limit, drop_empty, or_empty
from chartloom.operators.keyed import last_wins
from chartloom.operators.lookups import (
    attach_links,
    attach_lists,
    attach_struct,
    list_by_two_keys,
    other_columns,
    with_probe,
)
from chartloom.schemas import FEATURE_BASE_COLUMNS, with_columns

_EMPTY_COMMENTS = (
    "array<struct<comment_id:string,author:string,text:string,like_count:string,published_at:string,position:int>>"
)


def link_side(links: DataFrame) -> DataFrame:
    """Last link record per key, with a watch address where only the id is known.

    A record without ``name`` is known by its ``track_name``.
    """
    title = first_nonempty(F.col("name"), F.col("track_name"))
    keyed = with_columns(links, {"name": "string", "track_name": "string"}).select(
        joinable_key(track_key(title, F.col("artist"))).alias("track_key"),
        "youtube_id",
        first_nonempty(F.col("youtube_url"), watch_url(F.nullif(F.col("youtube_id"), F.lit("")))).alias("youtube_url"),
        "youtube_candidates",
        "ord",
    )
    return last_wins(keyed.filter(F.col("track_key").isNotNull()), "track_key", "ord").drop("ord")


def comment_rows(comments: DataFrame) -> DataFrame:
    """Comments by key; one without a key or ``track_name`` is known by its ``name``."""
    named = with_columns(comments, {"name": "string", "track_name": "string"})
    title = first_nonempty(F.col("track_name"), F.col("name"))
    key = first_nonempty(F.col("track_key"), track_key(title, F.col("artist")))
    return named.withColumn("track_key", joinable_key(key)).select(*comments.columns, *({"track_key"} - set(comments.columns)))


def award_side(awards: DataFrame) -> DataFrame:
    key = first_nonempty(F.col("track_key"), track_key(F.col("track_name"), F.col("artist")))
    rows = awards.select(joinable_key(key).alias("track_key"), or_empty(drop_empty(F.col("awards"))).alias("awards"), "ord")
    return last_wins(rows.filter(F.col("track_key").isNotNull()), "track_key", "ord").drop("ord")


def enrich(
    base: DataFrame,
    audio: DataFrame,
    features: DataFrame,
    links: DataFrame,
    comments: DataFrame,
    awards: DataFrame,
    limit: int = 10,
) -> DataFrame:
    """All five lookups, ordered so that neighbours share the base's partitioning.

    Two by catalogue id, then links and awards by track key, then comments by
    video id (known only after the links) and by track key.  Every input has a
    sortable ``ord``.
    """
    spread = ["ord"]
    base = with_columns(base, {"youtube_id": "string", "youtube_url": "string"})
    out = with_probe(base, F.col("spotify_track_id"), "__by_id", spread)
    audio_value = F.col("audio_metadata")
    out = attach_struct(out, audio, "spotify_track_id", ["ord"], audio_value, "audio_metadata", spread, "__by_id")
    dynamic = other_columns(features, (*FEATURE_BASE_COLUMNS, "ord"))
    out = attach_struct(out, features, "spotify_track_id", ["ord"], dynamic, "spotify_audio_features", spread, "__by_id")
    key = joinable_key(track_key(F.col("name"), F.col("artist")))
    out = with_probe(out.drop("__by_id"), key, "__by_key", spread)
    out = attach_links(out, link_side(links), "__by_key", spread)
    out = attach_lists(out.drop("awards"), award_side(awards), "__by_key", "track_key", "awards", spread)
    entry = [F.col(c) for c in ("comment_id", "author", "text", "like_count", "published_at")]
    entry.append(F.col("position").cast("int").alias("position"))
    n = comment_limit(limit)
    if n == 0:
        return out.withColumn("youtube_comments", F.array().cast(_EMPTY_COMMENTS)).drop("__by_key")
    out = list_by_two_keys(
        out,
        comment_rows(comments),
        ("youtube_id", "track_key"),
        (F.col("youtube_id"), "__by_key"),
        [F.coalesce(F.col("position"), F.lit(0)), F.col("ord")],
        n,
        entry,
        "youtube_comments",
        spread,
    )
    return out.drop("__by_key")


def canonical(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The output record: renamed, nested, defaults filled, the rest dropped."""
    df = with_columns(
        df,
        {
            "audio_metadata": "string",
            "spotify_audio_features": "string",
            "audio_preview_url": "string",
            "youtube_id": "string",
            "youtube_url": "string",
            "youtube_comments": _EMPTY_COMMENTS,
            "awards": "array<string>",
        },
    )
    comments = F.coalesce("youtube_comments", F.array().cast(df.schema["youtube_comments"].dataType.simpleString()))
    return df.select(
        *keep,
        "name",
        "artist",
        "year",
        F.col("place").alias("rank"),
        F.col("link").alias("wikipedia_link"),
        "spotify_track_id",
        "popularity",
        F.struct(
            F.col("lyrics").alias("text"),
            F.col("genius_status").alias("status"),
            F.col("genius_pageviews").alias("pageviews"),
            F.col("genius_release_date").alias("release_date"),
        ).alias("lyrics"),
        "audio_metadata",
        "spotify_audio_features",
        "audio_preview_url",
        "youtube_id",
        "youtube_url",
        comments.alias("youtube_comments"),
        or_empty(F.col("awards")).alias("awards"),
    )


def assemble(base, audio, features, links, comments, awards, limit: int = 10, keep: tuple[str, ...] = ()) -> DataFrame:
    return canonical(enrich(base, audio, features, links, comments, awards, limit), keep)
