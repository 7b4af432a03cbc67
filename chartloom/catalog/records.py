"""Projections, filters, slices, sources and sinks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from chartloom.catalog import query
from chartloom.catalog.joins import with_audio
from chartloom.catalog.standins import SONGS, songs, table
from chartloom.functions import text, values
from chartloom.operators import ordering, sourcing
from chartloom.plans import assemble as job
from chartloom.plans import incremental
from chartloom.schemas import AUDIO_FIELDS, audio_struct, clean_nans, ordered_values
from chartloom.session import new_workspace
from chartloom.sources import tables, yaml_text


@query("track_key", "SELECT p_partkey, lower(trim(p_name) || '|' || trim(p_brand)) AS track_key FROM part")
def track_key(spark, sf_dir):
    padded = F.concat(F.lit("\t "), F.upper("p_name"), F.lit("\xa0 "))
    return table(spark, sf_dir, "part").select("p_partkey", text.track_key(padded, F.col("p_brand")).alias("track_key"))


@query(
    "first_nonempty",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority WHEN o_orderstatus = 'P' THEN 'P' END AS picked
FROM orders""",
)
def first_nonempty(spark, sf_dir):
    status = F.col("o_orderstatus")
    a = F.when(status == "O", F.col("o_orderpriority")).when(status == "P", "")
    b = F.when(status == "P", status).when(status == "F", "")
    return table(spark, sf_dir, "orders").select("o_orderkey", text.first_nonempty(a, b).alias("picked"))


@query(
    "native_values",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value,
  CASE WHEN date_part('microsecond', ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS ts FROM events""",
)
def native_values(spark, sf_dir):
    dirty = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    rows = table(spark, sf_dir, "events").select("event_id", dirty.alias("value"), values.iso_text(F.col("ts")).alias("ts"))
    return clean_nans(rows)


@query("clamp", "SELECT p_partkey, CAST(least(greatest(p_size - 10, 0), 15) AS INTEGER) AS comment_limit FROM part")
def clamp(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", values.clamp_comment_limit(F.col("p_size") - 10).alias("comment_limit")
    )


@query(
    "canonical_record",
    f"""WITH {SONGS} SELECT ord, name, artist, year, place AS "rank", link AS wikipedia_link, spotify_track_id, popularity,
  lyrics AS text, genius_status AS status, genius_pageviews AS pageviews, 0 AS n_comments, 0 AS n_awards FROM songs""",
)
def canonical_record(spark, sf_dir):
    out = job.canonical(songs(spark, sf_dir), keep=("ord",))
    return out.select(
        "ord", "name", "artist", "year", "rank", "wikipedia_link", "spotify_track_id", "popularity",
        "lyrics.text", "lyrics.status", "lyrics.pageviews",
        F.size("youtube_comments").alias("n_comments"), F.size("awards").alias("n_awards"),
    )


@query(
    "ordered_features",
    """SELECT c_custkey, 58 AS n_fields, CAST(c_nationkey AS DOUBLE) AS first_value, c_acctbal AS tempo,
  3 AS n_set FROM customer""",
)
def ordered_features(spark, sf_dir):
    struct = audio_struct({"length": F.col("c_nationkey"), "tempo": F.col("c_acctbal"), "mfcc20_var": F.lit(1.0)})
    rows = table(spark, sf_dir, "customer").withColumn("audio_metadata", struct)
    listed = rows.withColumn("listed", ordered_values(F.col("audio_metadata"), AUDIO_FIELDS))
    return listed.select(
        "c_custkey",
        F.size("listed").alias("n_fields"),
        F.get("listed", F.lit(0)).alias("first_value"),
        F.get("listed", F.lit(AUDIO_FIELDS.index("tempo"))).alias("tempo"),
        F.size(F.array_compact("listed")).alias("n_set"),
    )



@query(
    "coerce_numeric",
    """SELECT event_id, CAST(trunc(x) AS INTEGER) AS year FROM (
  SELECT event_id, CASE event_type WHEN 'click' THEN value WHEN 'view' THEN trunc(value) END AS x FROM events)
WHERE x IS NOT NULL""",
)
def coerce_numeric(spark, sf_dir):
    raw = (
        F.when(F.col("event_type") == "click", F.col("value").cast("string"))
        .when(F.col("event_type") == "view", F.concat(F.lit(" "), F.col("value").cast("int").cast("string"), F.lit(" ")))
        .when(F.col("event_type") == "signup", F.lit("nan"))
        .when(F.col("event_type") == "error", F.lit("inf"))
        .otherwise(F.lit(text.UNKNOWN_YEAR))
    )
    rows = table(spark, sf_dir, "events").select("event_id", values.to_int(raw).alias("year"))
    return rows.filter(F.col("year").isNotNull())


@query(
    "coerce_default",
    """SELECT page_id, coalesce(TRY_CAST(split_part(split_part(split_part(url, '/', 5), '?', 1), '#', 1) AS INTEGER), 0) AS year
FROM pages""",
)
def coerce_default(spark, sf_dir):
    part = F.substring_index(F.substring_index(F.split_part("url", F.lit("/"), F.lit(5)), "?", 1), "#", 1)
    return table(spark, sf_dir, "pages").select("page_id", values.to_int_or_zero(part).alias("year"))


@query(
    "required_fields",
    """SELECT d.doc_id, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE d.text <> ''""",
)
def required_fields(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    whole = docs.na.drop(subset=["quality", "toxic", "text"]).filter(F.col("text") != "")
    return whole.select("doc_id", "quality", "toxic")


@query(
    "work_queue",
    f"WITH {SONGS} SELECT ord, genius_status FROM songs WHERE genius_status IS NULL OR contains(genius_status, 'Error')",
)
def work_queue(spark, sf_dir):
    return songs(spark, sf_dir).filter(values.needs_work(F.col("genius_status"))).select("ord", "genius_status")


@query(
    "pending_enrichment",
    "SELECT d.doc_id, d.source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
)
def pending_enrichment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return incremental.pending(docs, table(spark, sf_dir, "labels"), "doc_id")


_MISSING = f"""{SONGS}, gaps AS (
  SELECT s.*, concat_ws(', ', CASE WHEN spotify_track_id IS NULL THEN 'spotify_track_id' END,
    CASE WHEN spotify_track_id IS NULL OR NOT EXISTS (SELECT 1 FROM lineitem WHERE 'T' || l_partkey = s.spotify_track_id)
      THEN 'audio_metadata' END,
    CASE WHEN lyrics IS NULL THEN 'lyrics' END) AS missing
  FROM songs s)"""


@query("missing_fields", f"WITH {_MISSING} SELECT ord, missing FROM gaps")
def missing_fields(spark, sf_dir):
    rows = with_audio(spark, sf_dir)
    return rows.select("ord", F.array_join(incremental.missing_fields(), ", ").alias("missing"))


@query(
    "incomplete_report",
    f"WITH {_MISSING} SELECT ord, name || ' - ' || artist || ': missing ' || missing AS line FROM gaps WHERE missing <> ''",
)
def incomplete_report(spark, sf_dir):
    return incremental.incomplete_report(with_audio(spark, sf_dir))


@query(
    "status_class",
    f"""WITH {SONGS} SELECT ord, CASE WHEN genius_status IS NULL THEN 'Error / Pending'
  WHEN starts_with(genius_status, 'Success') THEN 'Success (Lyrics Found)'
  WHEN contains(genius_status, 'Lyrics Empty') THEN 'Found (No Lyrics)'
  WHEN contains(genius_status, 'Song Not Found') THEN 'Song Not Found'
  WHEN contains(genius_status, 'Ambiguous') THEN 'Ambiguous Match'
  WHEN contains(genius_status, 'Error') THEN 'Error / Pending' ELSE 'Other' END AS plot_status FROM songs""",
)
def status_class(spark, sf_dir):
    return songs(spark, sf_dir).select("ord", values.status_class(F.col("genius_status")).alias("plot_status"))


@query(
    "source_fallback",
    """SELECT o_orderkey,
  CASE WHEN p THEN c_acctbal WHEN s THEN o_totalprice END AS audio_metadata,
  CASE WHEN p THEN 'ok (preview)' WHEN s THEN 'ok (youtube)'
    WHEN c_mktsegment = 'BUILDING' THEN 'preview error: HTTP 404'
    WHEN c_custkey IS NOT NULL THEN 'empty audio from preview' ELSE 'error: no result' END AS audio_metadata_status,
  CASE WHEN p THEN c_name WHEN s THEN 'v' || o_orderkey END AS audio_preview_url,
  CASE WHEN p THEN 'spotify_preview' WHEN s THEN 'youtube_search' END AS audio_metadata_source
FROM (SELECT *, c_custkey IS NOT NULL AND c_mktsegment <> 'BUILDING' AND c_acctbal > 0 AS p, o_orderstatus <> 'F' AS s
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)""",
)
def source_fallback(spark, sf_dir):
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    rows = orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "left")
    broken = F.col("o_orderstatus") == "F"
    out = sourcing.preview_or_search(
        rows,
        preview_url=F.col("c_name"),
        preview_value=F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")),
        preview_error=F.when(F.col("c_mktsegment") == "BUILDING", "HTTP 404"),
        search_url=F.concat(F.lit("v"), F.col("o_orderkey").cast("string")),
        search_value=F.when(~broken, F.col("o_totalprice")),
        search_error=F.when(broken, "no result"),
    )
    return out.select("o_orderkey", "audio_metadata", "audio_metadata_status", "audio_preview_url", "audio_metadata_source")


@query(
    "link_reuse",
    """SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN 'stored' || p_partkey
    WHEN p_type = 'LARGE' THEN 'audio_' || p_partkey ELSE 'found' || p_size END AS youtube_id,
  CASE WHEN p_type = 'SMALL' THEN 'https://v.example/?v=stored' || p_partkey
    WHEN p_type = 'LARGE' THEN 'https://v.example/?v=audio_' || p_partkey
    ELSE 'https://www.youtube.com/watch?v=found' || p_size END AS youtube_url,
  CASE WHEN p_type = 'MEDIUM' THEN '/wiki/' || p_name ELSE '/search/' || p_brand END AS link
FROM part WHERE p_type NOT IN ('PROMO')""",
)
def link_reuse(spark, sf_dir):
    kind, key = F.col("p_type"), F.col("p_partkey").cast("string")
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", "p_size", "p_type",
        F.col("p_name").alias("name"), F.col("p_brand").alias("artist"),
        F.when(kind == "SMALL", F.concat(F.lit("https://v.example/?v=stored"), key)).alias("youtube_url"),
        F.when(kind == "LARGE", "YouTube_Search").otherwise("spotify_preview").alias("audio_metadata_source"),
        F.concat(F.lit("https://v.example/?v=audio_"), key).alias("audio_preview_url"),
        F.when(kind == "MEDIUM", F.concat(F.lit("/wiki/"), F.col("p_name"))).alias("link"),
    )
    hit = F.struct(
        F.concat(F.lit("found"), F.col("p_size").cast("string")).alias("youtube_id"), F.lit("").alias("youtube_url")
    )
    found = F.when(kind != "PROMO", F.array(hit))
    out = sourcing.reuse_page_link(
        sourcing.reuse_video_link(rows, found), F.concat(F.lit("/search/"), F.col("p_brand"))
    )
    return out.select("p_partkey", "youtube_id", "youtube_url", "link")


def _split_name(batches):
    for pdf in batches:
        words = pdf["p_name"].str.split(" ", n=1, expand=True).reindex(columns=[0, 1])
        yield pd.DataFrame({"p_partkey": pdf["p_partkey"], "colour": words[0], "thing": words[1]})


@query(
    "udf_struct",
    "SELECT p_partkey, split_part(p_name, ' ', 1) AS colour, split_part(p_name, ' ', 2) AS thing FROM part",
)
def udf_struct(spark, sf_dir):
    """A Python batch function that gives several columns."""
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return rows.mapInPandas(_split_name, "p_partkey bigint, colour string, thing string")


def _word_of(separator: str, place: int):
    """A batch function with arguments: one word of a text, marked by a number."""

    @F.pandas_udf("string")
    def run(texts: pd.Series, numbers: pd.Series) -> pd.Series:
        return texts.str.split(separator).str[place] + "/" + numbers.astype("Int64").astype(str)

    return run


@query("udf_arguments", "SELECT p_partkey, split_part(p_name, ' ', 2) || '/' || p_size AS marked FROM part")
def udf_arguments(spark, sf_dir):
    """A Python batch function of two columns, made with arguments."""
    parts = table(spark, sf_dir, "part")
    return parts.select("p_partkey", _word_of(" ", 1)(F.col("p_name"), F.col("p_size")).alias("marked"))


@query("slice_rows", "SELECT p_partkey, p_name FROM part WHERE p_partkey >= 20 AND p_partkey < 120")
def slice_rows(spark, sf_dir):
    return ordering.slice_rows(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey", 20, 100)


@query(
    "filter_then_limit",
    f"WITH {SONGS} SELECT ord, spotify_track_id FROM songs WHERE ord >= 20 AND spotify_track_id IS NOT NULL ORDER BY ord LIMIT 100",
)
def filter_then_limit(spark, sf_dir):
    rows = songs(spark, sf_dir).select("ord", "spotify_track_id")
    return ordering.filter_then_limit(rows, "ord", F.col("spotify_track_id").isNotNull(), 20, 100)


@query(
    "incremental_target",
    f"""WITH {SONGS}, prior AS (SELECT count(DISTINCT track_key) AS n FROM songs WHERE genius_status = 'Song Not Found'),
u AS (SELECT ord, name, artist, row_number() OVER (ORDER BY ord) AS pos FROM (
  SELECT *, row_number() OVER (PARTITION BY track_key ORDER BY ord) AS rn FROM songs) WHERE rn = 1)
SELECT ord, name, artist FROM u WHERE pos <= (SELECT n FROM prior) + 50""",
)
def incremental_target(spark, sf_dir):
    """Publish a first version, read it back as state, then go on from its size."""
    base = songs(spark, sf_dir).select("ord", "name", "artist", "genius_status")
    root = new_workspace(spark, "published")
    first = base.filter(F.col("genius_status") == "Song Not Found").withColumn(
        "track_key", text.track_key(F.col("name"), F.col("artist"))
    )
    tables.publish(first.select("track_key").distinct(), root)
    current = tables.read_published(spark, root, "track_key string").count()
    return incremental.next_target(base.drop("genius_status"), current, 50)


@query("head_preview", "SELECT p_partkey, p_name, p_size FROM part ORDER BY p_partkey LIMIT 5")
def head_preview(spark, sf_dir):
    return tables.preview(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"), "p_partkey")


@query("csv_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_roundtrip(spark, sf_dir):
    path = new_workspace(spark, "csv")
    tables.write_csv(table(spark, sf_dir, "documents"), path)
    return tables.read_csv(spark, path, "doc_id bigint, text string, lang string, source string, n_chars bigint", multi_line=True)


@query("json_roundtrip", "SELECT conv_id, turn, role, text FROM conversations")
def json_roundtrip(spark, sf_dir):
    path = new_workspace(spark, "json")
    tables.write_json(table(spark, sf_dir, "conversations"), path)
    return tables.read_json(spark, path, "conv_id bigint, turn bigint, role string, text string")


@query("yaml_roundtrip", "SELECT p_partkey, p_name, p_size, p_retailprice, [p_type] AS kinds FROM part")
def yaml_roundtrip(spark, sf_dir):
    """Published records as a list document, read back as state."""
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice", F.array("p_type").alias("kinds"))
    path = new_workspace(spark, "yaml")
    yaml_text.write_yaml(rows.withColumn("ord", F.col("p_partkey")), path, "ord")
    return yaml_text.read_yaml(spark, path, ", ".join(f"{c} {kind}" for c, kind in rows.dtypes))


@query(
    "yaml_rows",
    """SELECT '- p_partkey: ' || p_partkey AS value FROM part UNION ALL SELECT '  p_name: "' || p_name || '"' FROM part
UNION ALL SELECT '  p_size: ' || p_size FROM part UNION ALL SELECT '  p_retailprice: ' || p_retailprice FROM part
UNION ALL SELECT '  kinds:' FROM part UNION ALL SELECT '  - "' || p_type || '"' FROM part""",
)
def yaml_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ord"), "p_partkey", "p_name", "p_size", "p_retailprice", F.array("p_type").alias("kinds")
    )
    path = new_workspace(spark, "yaml")
    yaml_text.write_yaml(rows, path, "ord")
    return spark.read.text(path)
