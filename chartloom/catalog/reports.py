"""Quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartloom.catalog import query
from chartloom.catalog.standins import SONGS, songs, table
from chartloom.functions import values
from chartloom.operators import reports


def _labelled(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")


def _order_status():
    rank = F.substring("o_orderpriority", 1, 1)
    return (
        F.when(rank == "1", "Success (Strict)")
        .when(rank == "2", "Lyrics Empty (Heuristic)")
        .when(rank == "3", "Song Not Found")
        .when(rank == "4", "Ambiguous Match (No Year)")
        .when(F.col("o_orderstatus") == "P", "checked by hand")
    )


_CLASSES = """classed AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CASE substr(o_orderpriority, 1, 1)
  WHEN '1' THEN 'Success (Lyrics Found)' WHEN '2' THEN 'Found (No Lyrics)' WHEN '3' THEN 'Song Not Found'
  WHEN '4' THEN 'Ambiguous Match' ELSE CASE WHEN o_orderstatus = 'P' THEN 'Other' ELSE 'Error / Pending' END END AS c FROM orders)"""


def _classed(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("year"), values.status_class(_order_status()).alias("c")
    )


@query("top_values", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def top_values(spark, sf_dir):
    return reports.top_values(table(spark, sf_dir, "orders"), "o_custkey")


@query("count_per_year", "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1")
def count_per_year(spark, sf_dir):
    return reports.value_counts(table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")), "year").orderBy("year")


@query(
    "value_counts_nulls",
    "SELECT l.quality, count(*) AS n FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1",
)
def value_counts_nulls(spark, sf_dir):
    return reports.value_counts(_labelled(spark, sf_dir), "quality", keep_null=True)


_TAB = ", ".join(f"count_if(c = '{c}') AS \"{c}\"" for c in values.STATUS_CLASSES)


@query(
    "crosstab",
    f"""WITH {_CLASSES} SELECT year, CAST("Success (Lyrics Found)" AS BIGINT) AS "Success (Lyrics Found)",
  CAST("Found (No Lyrics)" AS BIGINT) AS "Found (No Lyrics)", CAST("Ambiguous Match" AS BIGINT) AS "Ambiguous Match",
  CAST("Song Not Found" AS BIGINT) AS "Song Not Found", CAST("Error / Pending" AS BIGINT) AS "Error / Pending", total
FROM (SELECT year, {_TAB}, count(*) AS total FROM classed GROUP BY year)""",
)
def crosstab(spark, sf_dir):
    return reports.crosstab(_classed(spark, sf_dir), "year", "c", list(values.STATUS_CLASSES))


@query(
    "crosstab_max",
    f"WITH {_CLASSES} SELECT max(n) AS max_total FROM (SELECT count(*) AS n FROM classed GROUP BY year)",
)
def crosstab_max(spark, sf_dir):
    tab = reports.crosstab(_classed(spark, sf_dir), "year", "c", list(values.STATUS_CLASSES))
    return tab.agg(F.max("total").alias("max_total"))


@query(
    "match_rate",
    f"""WITH {_CLASSES} SELECT count(*) AS total, CAST(count_if(c = 'Success (Lyrics Found)') AS BIGINT) AS found,
  round(100.0 * count_if(c = 'Success (Lyrics Found)') / count(*), 6) AS match_rate FROM classed""",
)
def match_rate(spark, sf_dir):
    hit = F.col("c") == values.STATUS_CLASSES[0]
    return _classed(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(hit).alias("found"),
        F.round(reports.rate(hit), 6).alias("match_rate"),
    )


@query(
    "status_report",
    f"""WITH {SONGS} SELECT count(*) AS total, CAST(count_if(genius_status = 'Success (Strict)') AS BIGINT) AS found,
  CAST(count_if(genius_status = 'Song Not Found') AS BIGINT) AS not_found,
  CAST(count_if(contains(genius_status, 'Lyrics Empty')) AS BIGINT) AS no_lyrics,
  CAST(count_if(genius_status IS NULL) AS BIGINT) AS unprocessed FROM songs""",
)
def status_report(spark, sf_dir):
    status = F.col("genius_status")
    return songs(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(status == "Success (Strict)").alias("found"),
        F.count_if(status == "Song Not Found").alias("not_found"),
        F.count_if(status.contains("Lyrics Empty")).alias("no_lyrics"),
        F.count_if(status.isNull()).alias("unprocessed"),
    )


@query(
    "null_counts",
    f"""WITH {SONGS} SELECT 'link' AS column_name, count(*) FILTER (link IS NULL) AS n_null FROM songs
UNION ALL SELECT 'spotify_track_id', count(*) FILTER (spotify_track_id IS NULL) FROM songs
UNION ALL SELECT 'lyrics', count(*) FILTER (lyrics IS NULL) FROM songs
UNION ALL SELECT 'name', count(*) FILTER (name IS NULL) FROM songs""",
)
def null_counts(spark, sf_dir):
    return reports.null_counts(songs(spark, sf_dir), ["link", "spotify_track_id", "lyrics", "name"])


@query(
    "cleaning_audit",
    """SELECT count(*) AS rows_before, CAST(count_if(event_type = 'error') AS BIGINT) AS rows_removed,
  CAST(count_if(event_type <> 'error') AS BIGINT) AS rows_after FROM events""",
)
def cleaning_audit(spark, sf_dir):
    raw = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    return reports.cleaning_audit(table(spark, sf_dir, "events"), values.to_number(raw).isNotNull())


@query("distinct_ids", "SELECT DISTINCT o_custkey FROM orders")
def distinct_ids(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_custkey").distinct()


@query(
    "id_batches",
    """SELECT CAST(floor((pos - 1) / 50) AS BIGINT) AS batch, count(*) AS n, string_agg(o_custkey, ',' ORDER BY pos) AS ids FROM (
  SELECT o_custkey, row_number() OVER (ORDER BY min(o_orderkey)) AS pos FROM orders GROUP BY o_custkey) GROUP BY 1""",
)
def id_batches(spark, sf_dir):
    out = reports.id_batches(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", 50)
    return out.select("batch", F.size("ids").cast("bigint").alias("n"), F.array_join("ids", ",").alias("ids"))
