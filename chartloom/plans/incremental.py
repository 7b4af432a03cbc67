"""Publish the next N records; prior output is the state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.text import track_key
from chartloom.functions.values import is_filled, missing_list
from chartloom.operators.keyed import complete_prefix, first_wins
from chartloom.operators.ordering import filter_then_limit, first_rows, nth_place, up_to
from chartloom.schemas import AUDIO_FIELDS
from chartloom.sources.tables import publish, read_published


def field_flags(audio_fields: list[str] | None = None) -> dict[str, Column]:
    """Presence of the fields a finished record needs."""
    has_id = F.col("spotify_track_id").isNotNull() & (F.col("spotify_track_id") != "")
    has_text = F.col("lyrics.text").isNotNull() & (F.col("lyrics.text") != "")
    return {
        "spotify_track_id": has_id,
        "audio_metadata": is_filled(F.col("audio_metadata"), audio_fields or AUDIO_FIELDS),
        "lyrics": has_text,
    }


def missing_fields() -> Column:
    return missing_list(**field_flags())


def incomplete_report(records: DataFrame) -> DataFrame:
    gaps = records.withColumn("missing", missing_fields()).filter(F.size("missing") > 0)
    return gaps.select(
        "ord", F.concat(F.format_string("%s - %s: missing ", "name", "artist"), F.array_join("missing", ", ")).alias("line")
    )


def pending(base: DataFrame, done: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Rows still to be enriched: those whose key has no done record."""
    return base if force else base.join(done.select(key).distinct(), key, "left_anti")


def audio_queue(base: DataFrame, offset: int = 0, limit: int | None = None, force: bool = False) -> DataFrame:
    """Rows whose clip is to be measured: offset, id set, limit, then not yet done."""
    rows = filter_then_limit(base, "ord", F.col("spotify_track_id").isNotNull(), offset, limit)
    return rows if force else rows.filter(~is_filled(F.col("audio_metadata"), AUDIO_FIELDS))


def publish_next(records: DataFrame, root: str, more: int, strict: bool = False) -> DataFrame:
    """One run: take the published table as state, append ``more`` further records.

    Returns the current table; nothing is written when the base is exhausted.  Records
    of published keys are not computed again, and the new ones once, as they are
    written.  The count of the state is the one number that comes to the driver.
    """
    spark = records.sparkSession
    current = read_published(spark, root, records.schema)
    target = next_target(records, current.count(), more, strict=strict)
    fresh = target.withColumn("__key", _key()).join(current.select(_key().alias("__key")).distinct(), "__key", "left_anti")
    publish(fresh.select(records.columns), root, append=True)
    return read_published(spark, root, records.schema)


def _key() -> Column:
    return track_key(F.col("name"), F.col("artist"))


def next_target(records: DataFrame, current: int, more: int, order: str = "ord", strict: bool = False) -> DataFrame:
    """First ``current + more`` distinct keys in base order.

    ``records`` has ``name``, ``artist``.  With ``strict`` only the prefix ahead
    of the first incomplete record is published.  The place of the last wanted key is
    found on keys and orders alone; rows beyond it are filtered before anything else is
    computed for them.
    """
    if current + more <= 0:
        return records.filter(F.lit(False))
    keyed = records.withColumn("__key", _key())
    firsts = keyed.groupBy("__key").agg(F.min(order).alias(order))
    found = nth_place(firsts, F.struct(F.col(order).alias("o")), current + more)
    near = keyed if found is None else keyed.filter(up_to(order, found[0]["o"], records.schema[order].dataType))
    out = first_wins(near, "__key", order).select(records.columns)
    if found is not None and found[2] > current + more:  # several keys at the last place
        out = first_rows(out, order, current + more)
    if strict:
        flags = field_flags()
        out = complete_prefix(out, order, flags["spotify_track_id"] & flags["audio_metadata"])
    return out
