"""The same work on streams; the SQL is that of the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartloom.catalog import query
from chartloom.catalog.standins import AUDIO, LINKS, audio_rows, link_rows, text_id
from chartloom.functions.text import joinable_key, track_key
from chartloom.operators import lookups
from chartloom.plans.assemble import link_side
from chartloom.session import new_workspace, tune
from chartloom.sources.tables import stage
from chartloom.streaming import flows

_STAGES = ["signup", "view", "click", "purchase"]


@query(
    "stream_enrich",
    f"""WITH {AUDIO}, {LINKS} SELECT p_partkey AS ord, CAST(a.l_quantity AS BIGINT) AS length, a.l_discount AS rms_mean,
  l.youtube_id, l.youtube_url FROM part LEFT JOIN audio a ON p_partkey = a.l_partkey
LEFT JOIN links l ON lower(p_name || '|' || p_brand) = l.track_key""",
)
def stream_enrich(spark, sf_dir):
    """Songs flow in; the lookup sides are built once and then joined to every batch."""
    root = new_workspace(spark, "stream-enrich")
    songs = flows.file_stream(tune(spark), sf_dir, "part.parquet").select(
        F.col("p_partkey").alias("ord"), F.col("p_name").alias("name"), F.col("p_brand").alias("artist"),
        text_id("T", "p_partkey").alias("spotify_track_id"),
    )
    links = stage(spark, f"{root}/links", lambda: link_side(link_rows(spark, sf_dir)))
    audio = stage(spark, f"{root}/audio", lambda: audio_rows(spark, sf_dir))
    out = lookups.attach_struct(
        songs, audio, "spotify_track_id", ["ord"], F.col("audio_metadata"), "audio_metadata", ["ord"]
    )
    out = lookups.attach_links(out, links, joinable_key(track_key(F.col("name"), F.col("artist"))), ["ord"])
    flows.append_to(out, root)
    return flows.read_appended(spark, root).select(
        "ord", "audio_metadata.length", "audio_metadata.rms_mean", "youtube_id", "youtube_url"
    )


@query(
    "stream_stage_state",
    """SELECT user_id, concat_ws(',', CASE WHEN count_if(event_type = 'signup') > 0 THEN 'signup' END,
  CASE WHEN count_if(event_type = 'view') > 0 THEN 'view' END, CASE WHEN count_if(event_type = 'click') > 0 THEN 'click' END,
  CASE WHEN count_if(event_type = 'purchase') > 0 THEN 'purchase' END) AS stages,
  count(DISTINCT event_type) FILTER (event_type <> 'error') = 4 AS done FROM events GROUP BY user_id""",
)
def stream_stage_state(spark, sf_dir):
    root = new_workspace(spark, "stream-stages")
    events = flows.file_stream(tune(spark), sf_dir, "events.parquet").select("user_id", "event_type")
    flows.changes_to(flows.stage_state(events, "user_id", "event_type", _STAGES), root, ["user_id"], mode="update")
    return flows.read_changes(spark, root, ["user_id"]).withColumn("stages", F.array_join("stages", ","))


@query("stream_dedup", "SELECT DISTINCT lower(p_name || '|' || p_brand) AS track_key FROM part")
def stream_dedup(spark, sf_dir):
    root = new_workspace(spark, "stream-dedup")
    songs = flows.file_stream(tune(spark), sf_dir, "part.parquet")
    keys = songs.select(track_key(F.col("p_name"), F.col("p_brand")).alias("track_key"))
    flows.once_per_key(keys, root, "track_key")
    return flows.read_once(spark, root)


@query(
    "stream_upsert",
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
  FROM events) WHERE rn = 1""",
)
def stream_upsert(spark, sf_dir):
    root = new_workspace(spark, "stream-upsert")
    events = flows.file_stream(tune(spark), sf_dir, "events.parquet").select("user_id", "event_id", "event_type", "value")
    flows.changes_to(events, root, ["user_id"], order="event_id")
    return flows.read_changes(spark, root, ["user_id"], order="event_id")
