"""Scalar text functions on whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartloom.catalog import query
from chartloom.catalog.standins import table
from chartloom.functions import text, values


@query(
    "clean_text",
    r"""SELECT doc_id, nullif(trim(regexp_replace(text, '\n+', chr(10), 'g'), E' \n\t'), '') AS lyrics FROM documents""",
)
def clean_text(spark, sf_dir):
    """Each document gets the embed marker, a blank line and the trailing line the cleaner takes off."""
    marked = F.concat(F.lit("12EmbedShare URLCopyEmbedCopy"), F.col("text"), F.lit("\n\n3 Contributors and more"))
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_lyrics(marked).alias("lyrics"))


@query("clean_search", "SELECT p_partkey, p_name || '  ' || p_brand AS cleaned FROM part")
def clean_search(spark, sf_dir):
    raw = F.concat(
        F.col("p_name"), F.lit(" ("), F.col("p_type"), F.lit(") "), F.col("p_brand"), F.lit(" [live] - "), F.col("p_type"),
        F.lit(" - Remaster"),
    )
    return table(spark, sf_dir, "part").select("p_partkey", text.clean_search(raw).alias("cleaned"))


@query(
    "extract_id",
    """SELECT page_id, nullif(regexp_extract(url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END
  || 'v=' || split_part(split_part(url, '://', 2), '.', 1), 'v=([A-Za-z0-9_-]{6,})', 1), '') AS youtube_id FROM pages""",
)
def extract_id(spark, sf_dir):
    host = F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("."), F.lit(1))
    url = F.concat("url", F.when(F.col("url").contains("?"), "&").otherwise("?"), F.lit("v="), host)
    return table(spark, sf_dir, "pages").select("page_id", text.extract_id(url).alias("youtube_id"))


@query(
    "build_url",
    """SELECT item_id, 'https://www.youtube.com/watch?v=' || item_id AS watch,
  'https://en.wikipedia.org/wiki/' || replace(replace(url_encode(replace(text, ' ', '_')), '%2F', '/'), '%7E', '~') AS page
FROM benchmark""",
)
def build_url(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(
        "item_id", text.watch_url(F.col("item_id").cast("string")).alias("watch"), text.page_url(F.col("text")).alias("page")
    )


@query(
    "absolute_url",
    """SELECT page_id, CASE WHEN contains(url, '?') THEN regexp_replace(url, '[?#].*$', '') || '?p=2'
    WHEN contains(url, '#') THEN scheme || '//cdn.example/x' WHEN url LIKE '%/' THEN folder || 'b.html'
    WHEN url LIKE '%.html' THEN url ELSE root || '/wiki/A?x=1' END AS link
FROM (SELECT page_id, url, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS root, regexp_extract(url, '^(https?:)', 1) AS scheme,
  regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '') AS folder FROM pages)""",
)
def absolute_url(spark, sf_dir):
    url = F.col("url")
    link = (
        F.when(url.contains("?"), "?p=2")
        .when(url.contains("#"), "//cdn.example/x")
        .when(url.endswith("/"), "b.html")
        .when(url.endswith(".html"), url)
        .otherwise("/wiki/A?x=1")
    )
    return table(spark, sf_dir, "pages").select("page_id", text.absolute_url(url, link).alias("link"))


@query(
    "title_suffix",
    """SELECT doc_id, CASE WHEN contains(text, 'of ') THEN trim(string_split(text, 'of ')[-1], E' \\n\\t') ELSE 'UNKNOWN' END AS year
FROM documents""",
)
def title_suffix(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.title_suffix(F.col("text")).alias("year"))


@query(
    "search_query",
    """SELECT p_partkey, 'track:"' || p_name || '" artist:"' || p_brand || '"' AS strict_query, p_name || ' ' || p_brand AS loose_query,
  p_name || ' ' || p_brand || ' song' AS page_query, p_name || ' - ' || p_brand AS label FROM part""",
)
def search_query(spark, sf_dir):
    pair = F.col("p_name"), F.col("p_brand")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text.strict_query(*pair).alias("strict_query"),
        text.loose_query(*pair).alias("loose_query"),
        text.page_query(*pair).alias("page_query"),
        text.label(*pair).alias("label"),
    )


@query(
    "keyword_filter",
    f"""SELECT doc_id, {' OR '.join(f"contains(lower(text), '{w}')" for w in text.AWARD_WORDS)} AS relevant FROM documents""",
)
def keyword_filter(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.has_award_word(F.col("text")).alias("relevant"))


@query(
    "array_ops",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 2 END AS n_kept,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS first_item,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority ELSE '' END AS head FROM orders""",
)
def array_ops(spark, sf_dir):
    raw = F.when(F.col("o_orderstatus") != "O", F.array(F.lit(""), "o_orderpriority", F.lit(None), "o_orderstatus"))
    kept = values.or_empty(values.drop_empty(raw))
    return table(spark, sf_dir, "orders").withColumn("kept", kept).select(
        "o_orderkey",
        F.size("kept").alias("n_kept"),
        F.get("kept", F.lit(0)).alias("first_item"),
        F.array_join(values.head_of(F.col("kept"), 1), ";").alias("head"),
    )


@query(
    "candidate_arrays",
    """SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 'listed' || p_partkey || '|https://www.youtube.com/watch?v=listed' || p_partkey
    || ';fromurl' || p_partkey || '|https://v.example/?v=fromurl' || p_partkey
  ELSE 'single' || p_partkey || '|https://v.example/?v=single' || p_partkey END AS candidates
FROM part WHERE p_type <> 'PROMO'""",
)
def candidate_arrays(spark, sf_dir):
    kind, key, none = F.col("p_type"), F.col("p_partkey").cast("string"), F.lit(None).cast("string")

    def pair(vid, url):
        return F.struct(vid.alias("youtube_id"), url.alias("youtube_url"))

    listed = F.when(
        kind == "SMALL",
        F.array(
            pair(F.concat(F.lit("listed"), key), none),
            pair(none, F.lit("https://v.example/short")),
            pair(F.lit(""), F.concat(F.lit("https://v.example/?v=fromurl"), key)),
        ),
    )
    url = F.when(kind != "PROMO", F.concat(F.lit("https://v.example/?v=single"), key))
    rows = table(spark, sf_dir, "part").withColumn("c", values.candidate_list(listed, none, url)).filter(F.size("c") > 0)
    shown = F.array_join(F.transform("c", lambda x: F.concat_ws("|", x["youtube_id"], x["youtube_url"])), ";")
    return rows.select("p_partkey", shown.alias("candidates"))


@query(
    "normalize_text",
    r"""SELECT doc_id, trim(regexp_replace(regexp_replace(lower(strip_accents(text)), '[^\x00-\x7F]+', '', 'g'), '[^a-z0-9]+', ' ', 'g')) AS words
FROM documents""",
)
def normalize_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.normalize_text(F.col("text")).alias("words"))
