"""Candidate matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartloom.catalog import query
from chartloom.catalog.standins import table
from chartloom.functions.similarity import token_set_ratio
from chartloom.functions.values import year_score as score_year
from chartloom.operators import keyed, matching


@query(
    "cascade_match",
    """WITH cat AS (SELECT p_partkey AS pos, 'T' || p_partkey AS id, CAST(p_size AS BIGINT) AS popularity,
    CASE WHEN p_type = 'PROMO' THEN p_name || ' (Remastered)' WHEN p_type = 'LARGE' THEN upper(p_name) ELSE p_name END AS title,
    CASE WHEN p_type = 'SMALL' THEN p_brand || ' [duo]' ELSE p_brand END AS artist FROM part),
s AS (SELECT * FROM (SELECT *, lower(title || '|' || artist) AS k, row_number() OVER (PARTITION BY lower(title || '|' || artist) ORDER BY pos) AS rn FROM cat) WHERE rn = 1),
wkeys AS (SELECT *, array_to_string(list_sort(list_distinct(string_split(trim(regexp_replace(lower(
  replace(title, ' (Remastered)', '') || ' ' || replace(artist, ' [duo]', '')), '[^a-z0-9]+', ' ', 'g')), ' '))), ' ') AS k FROM cat),
w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY pos) AS rn FROM wkeys) WHERE rn = 1),
q AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name AS name, p_brand AS artist,
  array_to_string(list_sort(list_distinct(string_split(trim(regexp_replace(lower(p_name || ' ' || p_brand), '[^a-z0-9]+', ' ', 'g')), ' '))), ' ') AS wk
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT q.l_orderkey, q.l_linenumber, q.l_partkey, q.l_suppkey, coalesce(s.id, w.id) AS spotify_track_id,
  coalesce(s.popularity, w.popularity) AS popularity,
  CASE WHEN s.id IS NOT NULL THEN 'strict' WHEN w.id IS NOT NULL THEN 'loose' END AS match_method
FROM q LEFT JOIN s ON lower(q.name || '|' || q.artist) = s.k LEFT JOIN w ON q.wk = w.k""",
)
def cascade_match(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    kind = F.col("p_type")
    catalogue = parts.select(
        F.col("p_partkey").alias("pos"),
        F.concat(F.lit("T"), F.col("p_partkey").cast("string")).alias("id"),
        F.col("p_size").cast("bigint").alias("popularity"),
        F.when(kind == "PROMO", F.concat("p_name", F.lit(" (Remastered)")))
        .when(kind == "LARGE", F.upper("p_name"))
        .otherwise(F.col("p_name"))
        .alias("title"),
        F.when(kind == "SMALL", F.concat("p_brand", F.lit(" [duo]"))).otherwise(F.col("p_brand")).alias("artist"),
    )
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    lines = table(spark, sf_dir, "lineitem").select(*keys)
    names = parts.select("p_partkey", F.col("p_name").alias("name"), F.col("p_brand").alias("artist"))
    base = lines.join(names, lines["l_partkey"] == names["p_partkey"]).drop("p_partkey")
    out = matching.cascade_match(base, catalogue, "l_orderkey")
    return out.select(*keys, "spotify_track_id", "popularity", "match_method")


@query(
    "argmax_first",
    """SELECT l_orderkey, l_quantity, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_quantity DESC, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1""",
)
def argmax_first(spark, sf_dir):
    pos = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", pos.alias("pos"))
    return keyed.argmax_first(rows, "l_orderkey", F.col("l_quantity"), "pos").select("l_orderkey", "l_quantity", "pos.*")


def _asked(spark, sf_dir):
    """Each order asks for the part numbered like its customer."""
    orders, parts = table(spark, sf_dir, "orders"), table(spark, sf_dir, "part")
    return orders.join(parts, orders["o_custkey"] == parts["p_partkey"])


def _offered(spark, sf_dir):
    """The lines of an order are its search results, in line order."""
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    joined = lines.join(parts, lines["l_partkey"] == parts["p_partkey"])
    return joined.withColumn("pos", F.struct("l_linenumber", "l_partkey", "l_suppkey"))


_OFFERED = """asked AS (SELECT o_orderkey AS query_ord, p_name AS name, p_brand AS artist, year(o_orderdate) AS year, o_orderstatus
  FROM orders JOIN part ON o_custkey = p_partkey),
offered AS (SELECT l_orderkey AS query_ord, p_name, p_brand, p_type, p_partkey, year(l_shipdate) AS year, l_quantity, l_returnflag, l_linestatus, l_linenumber, l_partkey, l_suppkey,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS pos FROM lineitem JOIN part ON l_partkey = p_partkey)"""


@query(
    "score_candidates",
    f"""WITH {_OFFERED}, s AS (SELECT o.query_ord, o.pos, l_linenumber, l_partkey, l_suppkey, title, (CASE WHEN contains(lower(title), '(song') THEN 2.5 ELSE 0 END
  + CASE WHEN contains(nt, a.name) THEN 3.0 ELSE 0 END + CASE WHEN contains(nt, na) THEN 1.0 ELSE 0 END
  + CASE WHEN contains(ns, na) THEN 0.5 ELSE 0 END)::DOUBLE AS score
  FROM (SELECT *, trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')) AS nt, regexp_replace(lower(p_brand), '[^a-z0-9]+', ' ', 'g') AS ns
    FROM (SELECT *, CASE l_returnflag WHEN 'R' THEN upper(p_name) || ' (song)' WHEN 'A' THEN p_name || ' by ' || p_brand ELSE p_name END AS title
      FROM offered)) o
  JOIN (SELECT *, regexp_replace(lower(artist), '[^a-z0-9]+', ' ', 'g') AS na FROM asked) a ON o.query_ord = a.query_ord)
SELECT query_ord, l_linenumber, l_partkey, l_suppkey, title, score, 'https://en.wikipedia.org/wiki/' || url_encode(replace(title, ' ', '_')) AS link FROM (
  SELECT *, row_number() OVER (PARTITION BY query_ord ORDER BY score DESC, pos) AS rn FROM s) WHERE rn = 1""",
)
def score_candidates(spark, sf_dir):
    queries = _asked(spark, sf_dir).select(
        F.col("o_orderkey").alias("query_ord"), F.col("p_name").alias("name"), F.col("p_brand").alias("artist")
    )
    flag = F.col("l_returnflag")
    title = (
        F.when(flag == "R", F.concat(F.upper("p_name"), F.lit(" (song)")))
        .when(flag == "A", F.concat("p_name", F.lit(" by "), "p_brand"))
        .otherwise(F.col("p_name"))
    )
    hits = _offered(spark, sf_dir).select(
        F.col("l_orderkey").alias("query_ord"), "pos", title.alias("title"), F.col("p_brand").alias("snippet")
    )
    return matching.score_pages(queries, hits).select("query_ord", "pos.*", "title", "score", "link")


@query(
    "year_score",
    """SELECT o_orderkey, CASE WHEN c_nationkey IS NULL THEN 0 WHEN abs(year(o_orderdate) - (1985 + c_nationkey)) <= 4 THEN 100
  WHEN abs(year(o_orderdate) - (1985 + c_nationkey)) <= 5 THEN 50 ELSE 0 END AS score
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def year_score(spark, sf_dir):
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    rows = orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "left")
    return rows.select("o_orderkey", score_year(F.col("c_nationkey") + 1985, F.year("o_orderdate")).alias("score"))


# Similarity of two names in SQL: LCS row by row over the characters of the first remainder.
_RATIO = """words AS (SELECT a, b, list_sort(list_distinct(string_split(a, ' '))) AS wa, list_sort(list_distinct(string_split(b, ' '))) AS wb FROM pairs),
parts AS (SELECT a, b, array_to_string(list_filter(wa, lambda x: list_contains(wb, x)), ' ') AS c,
  array_to_string(list_filter(wa, lambda x: NOT list_contains(wb, x)), ' ') AS ra,
  array_to_string(list_filter(wb, lambda x: NOT list_contains(wa, x)), ' ') AS rb FROM words),
lcs AS (SELECT ra, rb, 0 AS i, list_transform(range(0, length(rb) + 1), lambda x: 0) AS row FROM (SELECT DISTINCT ra, rb FROM parts)
  UNION ALL SELECT ra, rb, i + 1, list_transform(range(1, length(rb) + 2), lambda j: list_max(list_transform(range(1, j + 1), lambda k:
    CASE WHEN k > 1 AND substr(ra, i + 1, 1) = substr(rb, k - 1, 1) THEN greatest(row[k - 1] + 1, row[k]) ELSE row[k] END)))
  FROM lcs WHERE i < length(ra)),
ratio AS (SELECT a, b, CASE WHEN c <> '' AND (parts.ra = '' OR parts.rb = '') THEN 100 ELSE CAST(round_even(greatest(
    200.0 * (row[-1] + CASE WHEN c = '' THEN 0 ELSE length(c) + 1 END)
      / (length(parts.ra) + length(parts.rb) + CASE WHEN c = '' THEN 0 ELSE 2 * length(c) + 2 END),
    CASE WHEN c = '' THEN 0 ELSE 200.0 * length(c) / (2 * length(c) + 1 + length(parts.ra)) END,
    CASE WHEN c = '' THEN 0 ELSE 200.0 * length(c) / (2 * length(c) + 1 + length(parts.rb)) END), 0) AS INTEGER) END AS score
  FROM parts JOIN lcs ON parts.ra = lcs.ra AND parts.rb = lcs.rb AND i = length(parts.ra))"""


@query(
    "token_set_ratio",
    f"""WITH RECURSIVE pairs AS (SELECT DISTINCT x.p_name AS a, y.p_name AS b FROM orders JOIN part x ON o_custkey = x.p_partkey
  JOIN lineitem ON l_orderkey = o_orderkey JOIN part y ON l_partkey = y.p_partkey), {_RATIO}
SELECT a, b, score FROM ratio""",
)
def token_set(spark, sf_dir):
    """Names asked for against names offered, each distinct pair once."""
    asked = _asked(spark, sf_dir).select("o_orderkey", F.col("p_name").alias("a"))
    offered = _offered(spark, sf_dir).select("l_orderkey", F.col("p_name").alias("b"))
    pairs = asked.join(offered, asked["o_orderkey"] == offered["l_orderkey"]).select("a", "b").distinct()
    return pairs.withColumn("score", token_set_ratio(F.col("a"), F.col("b")))


@query(
    "entity_resolution",
    f"""WITH RECURSIVE {_OFFERED}, pairs AS (SELECT DISTINCT a.name AS a, o.p_name AS b FROM asked a JOIN offered o ON a.query_ord = o.query_ord), {_RATIO},
scored AS (SELECT o.*, r.score, abs(o.year - a.year) <= 5 AS in_window FROM offered o JOIN asked a ON o.query_ord = a.query_ord
  JOIN ratio r ON r.a = a.name AND r.b = o.p_name WHERE l_linestatus = 'F'),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_ord ORDER BY score DESC, pos) AS rn FROM scored) WHERE rn = 1),
seen AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_ord ORDER BY l_quantity DESC, pos) AS rn FROM scored WHERE in_window) WHERE rn = 1),
picked AS (SELECT b.query_ord, CASE WHEN b.score > 70 THEN b.p_partkey ELSE s.p_partkey END AS id,
  CASE WHEN b.score > 70 THEN 'Artist-Fuzz' WHEN s.p_partkey IS NOT NULL THEN 'Heuristic' END AS method FROM best b LEFT JOIN seen s ON b.query_ord = s.query_ord)
SELECT a.query_ord, CASE WHEN a.o_orderstatus = 'P' THEN a.name WHEN d.p_type <> 'SMALL' THEN d.p_type END AS lyrics,
  CASE WHEN a.o_orderstatus = 'P' THEN 'Success (Strict)' WHEN p.query_ord IS NULL THEN 'Song Not Found'
    WHEN method IS NULL THEN 'Ambiguous Match (No Year)' WHEN d.p_type = 'SMALL' THEN 'Lyrics Empty (' || method || ')'
    ELSE 'Success (' || method || ')' END AS genius_status,
  CASE WHEN a.o_orderstatus = 'P' THEN 7 ELSE CAST(d.p_size AS BIGINT) END AS genius_pageviews
FROM asked a LEFT JOIN picked p ON a.query_ord = p.query_ord LEFT JOIN part d ON d.p_partkey = p.id""",
)
def entity_resolution(spark, sf_dir):
    asked = _asked(spark, sf_dir).select(
        F.col("o_orderkey").alias("query_ord"),
        F.lit("x").alias("name"),
        F.col("p_name").alias("artist"),
        F.year("o_orderdate").alias("year"),
        "o_orderstatus",
    )
    none = F.lit(None).cast("string").alias("release_date")
    strict = asked.filter(F.col("o_orderstatus") == "P").select(
        "query_ord", F.col("artist").alias("lyrics"), F.lit(7).cast("bigint").alias("pageviews"), none
    )
    hits = _offered(spark, sf_dir).select(
        F.col("l_orderkey").alias("query_ord"),
        "pos",
        F.when(F.col("l_linestatus") == "F", "song").otherwise("album").alias("type"),
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("artist_names"),
        F.struct(F.year("l_shipdate").alias("year")).alias("release_date_components"),
        F.col("l_quantity").cast("bigint").alias("pageviews"),
    )
    details = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_type") != "SMALL", F.col("p_type")).alias("lyrics"),
        F.col("p_size").cast("bigint").alias("pageviews"),
        none,
    )
    out = matching.resolve(asked, strict, hits, details)
    return out.select("query_ord", "lyrics", "genius_status", "genius_pageviews")
