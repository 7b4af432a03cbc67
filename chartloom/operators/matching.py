"""Candidate matching on captured search results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.similarity import ARTIST_THRESHOLD, page_score, word_set_ratio, words
from chartloom.functions.text import clean_lyrics, clean_search, joinable_key, normalize_text, page_url, track_key
from chartloom.functions.values import year_score
from chartloom.operators.keyed import argmax_first, first_wins
from chartloom.operators.lookups import left_lookup


def cascade_match(base: DataFrame, catalogue: DataFrame, row: str) -> DataFrame:
    """Strict match on title and artist, else a looser one, first hit only.

    ``catalogue``: pos, id, popularity, title, artist.  It is cut to its first
    hit per strict key and per loose key before the joins, so equal titles
    never pair up with one another.
    """

    def with_loose_key(rows, name, artist):
        # The cleaned text is a column of its own: several expressions read it.
        cleaned = rows.withColumn("__text", F.concat_ws(" ", clean_search(name), clean_search(artist)))
        parts = F.split(normalize_text(F.col("__text")), " ")
        key = F.nullif(F.array_join(F.array_sort(F.array_distinct(parts)), " "), F.lit(""))
        return cleaned.withColumn("__wide", key).drop("__text")

    strict_key = joinable_key(track_key(F.col("title"), F.col("artist")))
    strict = first_wins(catalogue.select(strict_key.alias("sk"), "pos", F.struct("id", "popularity").alias("strict_hit")).filter("sk IS NOT NULL"), "sk", "pos")
    keyed = with_loose_key(catalogue, F.col("title"), F.col("artist"))
    wide = first_wins(keyed.select(F.col("__wide").alias("wk"), "pos", F.struct("id", "popularity").alias("loose_hit")).filter("wk IS NOT NULL"), "wk", "pos")
    tried = left_lookup(base, strict.drop("pos"), joinable_key(track_key(F.col("name"), F.col("artist"))), "sk", [row])
    # Only rows without a strict hit carry text into the costlier key.
    left_over = [F.when(F.col("strict_hit").isNull(), F.col(c)) for c in ("name", "artist")]
    tried = with_loose_key(tried, *left_over)
    both = left_lookup(tried, wide.drop("pos"), F.col("__wide"), "wk", [row]).drop("__wide")
    hit = F.coalesce("strict_hit", "loose_hit")
    return (
        both.withColumn("spotify_track_id", hit["id"])
        .withColumn("popularity", hit["popularity"])
        .withColumn(
            "match_method",
            F.when(F.col("strict_hit").isNotNull(), "strict").when(F.col("loose_hit").isNotNull(), "loose"),
        )
        .drop("strict_hit", "loose_hit")
    )


def score_pages(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """Best page per query (query_ord, name, artist) among its candidates."""
    norm = queries.select("query_ord", normalize_text(F.col("name")).alias("__n"), normalize_text(F.col("artist")).alias("__a"))
    scored = candidates.join(norm, "query_ord").select(
        "query_ord",
        "pos",
        "title",
        page_score(
            F.col("title"), normalize_text(F.col("title")), normalize_text(F.col("snippet")), F.col("__n"), F.col("__a")
        ).alias("score"),
    )
    best = argmax_first(scored, "query_ord", F.col("score"), "pos")
    return best.withColumn("link", page_url(F.nullif(F.col("title"), F.lit(""))))


def resolve(queries: DataFrame, strict: DataFrame, hits: DataFrame, details: DataFrame) -> DataFrame:
    """Strict hit, else best artist, else most viewed in the year window.

    queries: query_ord, name, artist, year;  strict: query_ord, lyrics,
    pageviews, release_date;  hits: query_ord, pos, type, id, artist_names,
    release_date_components, pageviews;  details: id, lyrics, pageviews,
    release_date.  ``pos`` is any sortable column.  Of several responses the one of
    the greatest ``ord`` counts (if there is no such column, any one).  Lyrics are
    cleaned before they count; queries with a strict hit are not scored.

    Artist scores count above the threshold only, so hits that cannot pass it are not
    compared letter by letter.  The picks are one aggregate per query, so a query with very many hits merges
    map-side.
    """
    asked = queries.join(strict.select("query_ord").distinct(), "query_ord", "left_anti").select("query_ord", words(clean_search(F.col("artist"))).alias("__mine"), F.col("year").alias("__year"))
    theirs = words(clean_search(F.col("artist_names"))).alias("__theirs")
    songs = hits.filter(F.col("type") == "song").select(
        "query_ord", "pos", "id", "pageviews", F.col("release_date_components.year").alias("__hit_year"), theirs
    ).join(asked, "query_ord")
    scored = songs.withColumn("artist_score", word_set_ratio(F.col("__mine"), F.col("__theirs"), ARTIST_THRESHOLD)).withColumn("year_score", year_score(F.col("__hit_year"), F.col("__year")))
    pick = F.struct("id", "artist_score")
    views = F.coalesce(F.col("pageviews"), F.lit(0))
    picks = scored.groupBy("query_ord").agg(
        F.min_by(pick, F.struct(-F.col("artist_score"), "pos")).alias("by_artist"),
        F.min_by("id", F.when(F.col("year_score") > 0, F.struct(-views, "pos"))).alias("by_year"),
    )
    near = F.col("by_artist.artist_score") > ARTIST_THRESHOLD
    chosen = picks.select(
        "query_ord",
        F.when(near, F.col("by_artist.id")).otherwise(F.col("by_year")).alias("match_id"),
        F.when(near, "Artist-Fuzz").when(F.col("by_year").isNotNull(), "Heuristic").alias("method"),
        F.lit(True).alias("has_hits"),
    )
    text = F.nullif(clean_lyrics(F.col("lyrics")), F.lit(""))
    response = F.struct(text.alias("lyrics"), "pageviews", "release_date")

    def last(responses: DataFrame) -> F.Column:
        return F.max_by(response, "ord") if "ord" in responses.columns else F.max(response)

    found = left_lookup(
        chosen,
        details.groupBy(F.col("id").alias("__id")).agg(last(details).alias("d")),
        F.col("match_id"),
        "__id",
        ["query_ord"],
    )
    first = strict.groupBy("query_ord").agg(last(strict).alias("s"))
    joined = queries.join(first, "query_ord", "left").join(found, "query_ord", "left")
    code = F.when(F.col("d").isNull(), "Error (Code)").when(F.col("d.lyrics").isNull(), "Lyrics Empty").otherwise("Success")
    status = (
        F.when(F.col("s").isNotNull(), F.when(F.col("s.lyrics").isNull(), "Lyrics Empty (Strict)").otherwise("Success (Strict)"))
        .when(F.col("has_hits").isNull(), "Song Not Found")
        .when(F.col("method").isNull(), "Ambiguous Match (No Year)")
        .otherwise(F.concat(code, F.lit(" ("), F.col("method"), F.lit(")")))
    )
    kept = F.coalesce("s", "d")
    return joined.select(
        *queries.columns,
        kept["lyrics"].alias("lyrics"),
        status.alias("genius_status"),
        kept["pageviews"].alias("genius_pageviews"),
        kept["release_date"].alias("genius_release_date"),
    )
