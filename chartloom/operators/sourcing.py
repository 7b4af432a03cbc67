"""Which of two sources a value comes from, and which stored links are reused."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.text import extract_id, first_nonempty, watch_url
from chartloom.functions.values import candidate_list

# ---- fixed values -----------------------------------------------------------
FROM_PREVIEW, FROM_SEARCH = "spotify_preview", "youtube_search"
OK_PREVIEW, OK_SEARCH = "ok (preview)", "ok (youtube)"
EMPTY_PREVIEW = "empty audio from preview"
PREVIEW_ERROR, SEARCH_ERROR = "preview error: ", "error: "
# -----------------------------------------------------------------------------


def preview_or_search(
    df: DataFrame,
    preview_url: Column,
    preview_value: Column,
    preview_error: Column,
    search_url: Column,
    search_value: Column,
    search_error: Column,
) -> DataFrame:
    """Value, url, label and status of a preview with a search as fallback.

    The status keeps the preview's failure text when the search fails too.
    """
    asked = preview_url.isNotNull() & (preview_url != "")
    preview_ok = asked & preview_error.isNull() & preview_value.isNotNull()
    search_ok = search_error.isNull() & search_value.isNotNull()

    def choose(first, second):
        return F.when(preview_ok, first).when(search_ok, second)

    preview_note = F.when(
        asked, F.coalesce(F.concat(F.lit(PREVIEW_ERROR), preview_error), F.lit(EMPTY_PREVIEW))
    )
    failed = F.coalesce(preview_note, F.concat(F.lit(SEARCH_ERROR), F.coalesce(search_error, F.lit(""))))
    return df.withColumns(
        {
            "audio_metadata": choose(preview_value, search_value),
            "audio_metadata_status": F.coalesce(choose(F.lit(OK_PREVIEW), F.lit(OK_SEARCH)), failed),
            "audio_preview_url": choose(preview_url, search_url),
            "audio_metadata_source": choose(F.lit(FROM_PREVIEW), F.lit(FROM_SEARCH)),
        }
    )


def _named(df: DataFrame) -> DataFrame:
    return df.filter((F.col("name") != "") & (F.col("artist") != ""))


def reuse_video_link(df: DataFrame, found: Column, force: bool = False) -> DataFrame:
    """Stored watch link when it holds an id, else the captured search results.

    ``df`` has name, artist, youtube_url, audio_metadata_source and
    audio_preview_url; ``found`` is an array of (youtube_id, youtube_url).
    Only rows that end with a candidate come out.
    """
    searched = F.lower("audio_metadata_source") == FROM_SEARCH
    stored = first_nonempty(F.col("youtube_url"), F.when(searched, F.col("audio_preview_url")))
    stored = F.when(F.lit(not force), stored)
    own_id = extract_id(stored)
    candidates = F.when(
        own_id.isNotNull(),
        F.array(F.struct(own_id.alias("youtube_id"), stored.alias("youtube_url"))),
    ).otherwise(candidate_list(found, F.lit(None).cast("string"), F.lit(None).cast("string")))
    out = _named(df).withColumn("youtube_candidates", candidates).filter(F.size("youtube_candidates") > 0)
    best = F.get("youtube_candidates", F.lit(0))
    return out.withColumn("youtube_id", best["youtube_id"]).withColumn(
        "youtube_url", first_nonempty(best["youtube_url"], watch_url(best["youtube_id"]))
    )


def reuse_page_link(df: DataFrame, found: Column, force: bool = False) -> DataFrame:
    """Stored page link unless a new search is forced; rows without one go."""
    stored = F.when(F.lit(not force), F.col("link"))
    return _named(df).withColumn("link", first_nonempty(stored, found)).filter(F.col("link").isNotNull())
