"""Anti and semi joins, deletes, upserts, base order."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartloom.catalog import query
from chartloom.catalog.standins import SONGS, songs, table
from chartloom.functions.text import track_key
from chartloom.operators import changes, ordering


def _old(spark, sf_dir):
    base = songs(spark, sf_dir)
    return base.select(
        "ord", track_key(F.col("name"), F.col("artist")).alias("track_key"), F.lit("old").alias("version"), "spotify_track_id"
    )


def _new(spark, sf_dir):
    """One row per order whose customer key is a part key."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = _old(spark, sf_dir)
    joined = orders.join(parts, orders["o_custkey"] == parts["ord"])
    rows = joined.select(F.col("o_orderkey").alias("ord"), "track_key", "spotify_track_id")
    return changes.with_defaults(rows, {"version": F.lit("new")})


_NEW = f"""{SONGS}, fresh AS (
  SELECT o_orderkey AS ord, track_key, 'new' AS version, spotify_track_id FROM orders JOIN songs ON o_custkey = ord)"""


@query(
    "anti_join_new",
    f"""WITH {_NEW}, n AS (
  SELECT ord, track_key, 'old' AS version FROM (SELECT *, row_number() OVER (PARTITION BY track_key ORDER BY ord) AS rn
    FROM songs WHERE track_key NOT IN (SELECT track_key FROM fresh)) WHERE rn = 1 ORDER BY ord LIMIT 40)
SELECT ord, track_key, version FROM fresh UNION ALL SELECT * FROM n""",
)
def anti_join_new(spark, sf_dir):
    published = _new(spark, sf_dir).drop("spotify_track_id")
    return changes.append_new(published, _old(spark, sf_dir).drop("spotify_track_id"), "track_key", "ord", room=40)


@query(
    "semi_join_existing",
    f"WITH {_NEW} SELECT ord, track_key FROM songs WHERE track_key IN (SELECT track_key FROM fresh)",
)
def semi_join_existing(spark, sf_dir):
    return changes.only_known(_old(spark, sf_dir), _new(spark, sf_dir), "track_key").select("ord", "track_key")


_LABELLED = """flagged AS (SELECT d.doc_id, d.lang || '/' || d.source AS place, d.text FROM documents d JOIN labels l
  ON d.doc_id = l.doc_id WHERE l.toxic = 1 AND l.quality = 0)"""


@query(
    "disjunctive_delete",
    f"""WITH {_LABELLED} SELECT d.doc_id, d.lang || '/' || d.source AS place, 'kept' AS state FROM documents d
WHERE d.text NOT IN (SELECT text FROM flagged) AND d.lang || '/' || d.source NOT IN (SELECT place FROM flagged)
UNION ALL SELECT doc_id, place, 'new' FROM flagged""",
)
def disjunctive_delete(spark, sf_dir):
    """Delete documents that share a flagged text or a flagged place, then append the flagged ones."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("/", "lang", "source").alias("place"), "text")
    bad = table(spark, sf_dir, "labels").filter((F.col("toxic") == 1) & (F.col("quality") == 0)).select("doc_id")
    flagged = docs.join(bad, "doc_id").withColumn("state", F.lit("new"))
    out = changes.replace_matching(docs.withColumn("state", F.lit("kept")), flagged, ["text", "place"])
    return out.select("doc_id", "place", "state")


@query(
    "upsert_keyed",
    f"""WITH {_NEW}, b AS (SELECT ord, track_key, 'old' AS version, 0 AS gen FROM songs
  UNION ALL SELECT ord, track_key, version, 1 FROM fresh)
SELECT track_key, ord, version, base_ord FROM (
  SELECT b.*, row_number() OVER (PARTITION BY b.track_key ORDER BY gen DESC, b.ord DESC) AS rn, p.base_ord
  FROM b JOIN (SELECT track_key, max(ord) AS base_ord FROM songs GROUP BY 1) p ON b.track_key = p.track_key) WHERE rn = 1""",
)
def upsert_keyed(spark, sf_dir):
    old = _old(spark, sf_dir).drop("spotify_track_id")
    positions = ordering.order_map(old, "track_key", "ord")
    new = _new(spark, sf_dir).drop("spotify_track_id")
    return changes.upsert_in_order(old, new, "track_key", "ord", positions, F.lit(-1))


@query(
    "order_by_reference",
    f"""WITH {_NEW}, p AS (SELECT track_key, max(ord) AS base_ord FROM songs WHERE spotify_track_id IS NOT NULL GROUP BY 1)
SELECT f.ord, f.track_key, coalesce(p.base_ord, (SELECT count(*) FROM songs) + 1) AS base_ord
FROM fresh f LEFT JOIN p ON f.track_key = p.track_key""",
)
def order_by_reference(spark, sf_dir):
    base = _old(spark, sf_dir)
    last = ordering.order_map(base.filter(F.col("spotify_track_id").isNotNull()), "track_key", "ord")
    rows = _new(spark, sf_dir).select("ord", "track_key")
    behind_all = base.agg((F.count(F.lit(1)) + 1).alias("n")).scalar()
    placed = ordering.by_reference_order(rows, "track_key", last, behind_all)
    return placed.orderBy("base_ord", "ord")
