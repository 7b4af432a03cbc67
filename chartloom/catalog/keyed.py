"""Rows per key: last, first, top N, positions, prefixes."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartloom.catalog import query
from chartloom.catalog.standins import LINE_ORDER, SONGS, songs, table
from chartloom.functions.text import track_key
from chartloom.operators import keyed, ordering


def _keyed_songs(spark, sf_dir):
    return songs(spark, sf_dir).withColumn("track_key", track_key(F.col("name"), F.col("artist")))


@query(
    "last_wins",
    """SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) AS rn
  FROM lineitem) WHERE rn = 1""",
)
def last_wins(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(*LINE_ORDER, "l_quantity")
    return keyed.last_wins(rows, "l_partkey", LINE_ORDER)


@query(
    "first_wins",
    f"""WITH {SONGS} SELECT track_key, ord, year FROM (
  SELECT *, row_number() OVER (PARTITION BY track_key ORDER BY ord) AS rn FROM songs) WHERE rn = 1""",
)
def first_wins(spark, sf_dir):
    return keyed.first_wins(_keyed_songs(spark, sf_dir).select("track_key", "ord", "year"), "track_key", "ord")


@query(
    "ordered_collect",
    """SELECT conv_id, string_agg(role || ':' || length(text), ' ' ORDER BY turn) AS turns FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations) WHERE rn <= 15 GROUP BY conv_id""",
)
def ordered_collect(spark, sf_dir):
    entry = [F.concat(F.col("role"), F.lit(":"), F.length("text").cast("string")).alias("t")]
    rows = keyed.collect_top(table(spark, sf_dir, "conversations"), "conv_id", ["turn"], 15, entry, "turns")
    return rows.select("conv_id", F.array_join(F.transform("turns", lambda x: x["t"]), " ").alias("turns"))


@query(
    "top_n_per_key",
    """SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_linenumber, l_orderkey, l_suppkey) AS rn FROM lineitem)
WHERE rn <= 10""",
)
def top_n_per_key(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey")
    return keyed.top_n(rows, "l_partkey", ["l_linenumber", "l_orderkey", "l_suppkey"], 10)


@query(
    "page_positions",
    """SELECT event_id, event_type, CAST(row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS BIGINT) AS position
FROM events""",
)
def page_positions(spark, sf_dir):
    """Five types hold all events: each is numbered block by block, and the blocks are summed up."""
    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    return ordering.add_position(rows, "event_id", ["event_type"], into="position")


@query(
    "first_nonempty_candidate",
    """SELECT l_orderkey, min(idx) AS idx FROM (
  SELECT l_orderkey, l_linenumber - 1 AS idx, count_if(l_returnflag = 'R') AS n FROM lineitem GROUP BY 1, 2)
WHERE n > 0 AND idx < 4 GROUP BY 1""",
)
def first_nonempty_candidate(spark, sf_dir):
    tries = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", (F.col("l_linenumber") - 1).alias("idx"))
        .agg(F.count_if(F.col("l_returnflag") == "R").alias("n"))
    )
    return keyed.first_with_rows(tries, "l_orderkey", "idx", F.col("n")).select("l_orderkey", "idx")


@query(
    "complete_prefix",
    "SELECT event_id, value FROM events WHERE event_id < (SELECT min(event_id) FROM events WHERE value > 200)",
)
def complete_prefix(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "value")
    return keyed.complete_prefix(rows, "event_id", F.col("value") <= 200)
