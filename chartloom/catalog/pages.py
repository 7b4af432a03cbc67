"""Captured pages and payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartloom.catalog import query
from chartloom.catalog.standins import table
from chartloom.functions import payloads as json_of
from chartloom.operators import comments, pages

# Entities of the test pages, '&amp;' last so that nothing is undone twice.
_PLAIN = "replace(replace(replace(replace({}, '&quot;', '\"'), '&middot;', '·'), '&copy;', '©'), '&amp;', '&')"
_TEXT = "trim(" + _PLAIN.format(
    "array_to_string(list_filter(string_split_regex({0}, '<[^>]*>'), lambda t: t <> ''), ' ')"
) + ", E' \\n\\t')"
_BLOCKS = f"""blocks AS (
  SELECT page_id, 0 AS layout, i - 1 AS block_no, {_TEXT.format('items[i]')} AS text FROM (
    SELECT page_id, items, unnest(range(1, len(items) + 1)) AS i FROM (
      SELECT page_id, regexp_extract_all(html, '<li>(.*?)</li>', 1, 's') AS items FROM pages))
  UNION ALL
  SELECT page_id, 1, i - 1, {_TEXT.format("regexp_extract(items[i], '^(.*?)(</p>|<footer>|$)', 1, 's')")} FROM (
    SELECT page_id, items, unnest(range(1, len(items) + 1)) AS i FROM (
      SELECT page_id, string_split(html, '<p>')[2:] AS items FROM pages)))"""


def _captured(spark, sf_dir):
    return table(spark, sf_dir, "pages")


def _wiki_pages(spark, sf_dir):
    """The pages with their body as the content box and articles unwrapped."""
    boxed = F.replace(F.replace("html", F.lit("<body>"), F.lit('<div class="mw-parser-output">')), F.lit("<article>"), F.lit(""))
    return _captured(spark, sf_dir).select("page_id", "url", boxed.alias("html"))


@query("html_blocks", f"WITH {_BLOCKS} SELECT page_id, layout, block_no, text FROM blocks WHERE text <> ''")
def html_blocks(spark, sf_dir):
    return pages.text_blocks(_wiki_pages(spark, sf_dir))


@query(
    "dedup_blocks",
    f"""WITH {_BLOCKS} SELECT page_id, layout, block_no, text FROM (
  SELECT *, row_number() OVER (PARTITION BY page_id, text ORDER BY layout, block_no) AS rn FROM blocks WHERE text <> '') WHERE rn = 1""",
)
def dedup_blocks(spark, sf_dir):
    return pages.distinct_blocks(pages.text_blocks(_wiki_pages(spark, sf_dir)))


@query(
    "page_links",
    """SELECT page_id, CAST(i - 1 AS INTEGER) AS link_no, labels[i] AS label,
  regexp_extract(url, '^(https?://[^/?#]*)', 1) || hrefs[i] AS link, regexp_full_match(labels[i], '[0-9]+') AS is_year FROM (
  SELECT page_id, url, hrefs, labels, unnest(range(1, len(hrefs) + 1)) AS i FROM (
    SELECT page_id, url, regexp_extract_all(html, '<li><a href="([^"]*)">', 1) AS hrefs,
      regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1) AS labels FROM pages))""",
)
def page_links(spark, sf_dir):
    return pages.page_links(_captured(spark, sf_dir), everywhere=True)


_TABLES = """SELECT p_partkey AS page_id, 0 AS table_no, 1 AS row_no, p_name AS name, p_brand || ' & ' || p_type AS artist,
  CAST(1946 + p_size AS VARCHAR) AS year, CAST(p_size AS VARCHAR) AS place,
  CASE WHEN p_type <> 'ECONOMY' THEN 'https://en.example.org/wiki/' || p_brand END AS link FROM part"""


def _chart_pages(spark, sf_dir):
    """One page per part: a heading, a chart with a short row, an entry, and another table."""
    cell = F.when(
        F.col("p_type") != "ECONOMY", F.format_string('"<a href="/wiki/%s">%s</a>"', "p_brand", "p_name")
    ).otherwise(F.format_string('"%s"', "p_name"))
    source = F.concat(
        F.format_string('<h1 id="firstHeading">Singles of %d</h1><table class="plain"><tr><td>x<td>y<td>z</table>', F.col("p_size") + 1946),
        F.lit('<table class="wikitable sortable"><tbody><tr><th>No.</th></tr>'),
        F.format_string("<tr><td>%d\n</td><td>", "p_size"),
        cell,
        F.format_string("</td><td>%s &amp; <i>%s</i></td></tr><tr><td>1</td><td>short</td></tr></tbody></table>", "p_brand", "p_type"),
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("page_id"), F.lit("https://en.example.org/wiki/Singles").alias("url"), source.alias("html")
    )


@query("html_tables", _TABLES)
def html_tables(spark, sf_dir):
    return pages.chart_rows(_chart_pages(spark, sf_dir))


@query("html_tables_sql", _TABLES)
def html_tables_sql(spark, sf_dir):
    """The same rows by the table function, joined laterally in SQL."""
    pages.register_page_rows(spark)
    made = pages.spread(_chart_pages(spark, sf_dir))
    rows = spark.sql("SELECT page_id, url, r.* FROM {made}, LATERAL page_rows(html, 'chart') AS r", made=made)
    return pages.as_entries(rows)


def _payloads(spark, sf_dir):
    """A payload per turn: one comment in the modern layout, again in the legacy one, and one without an id."""
    ident = F.concat_ws("-", F.lit("c"), "conv_id", "turn")

    def modern(content):
        props = F.struct(ident.alias("commentId"), content.alias("content"), F.col("turn").cast("string").alias("likeCount"),
                         F.lit("1 day ago").alias("publishedTime"), F.col("role").alias("authorButtonA11y"))
        entity = F.struct(F.struct(props.alias("properties")).alias("commentEntityPayload")).alias("payload")
        return F.struct(F.struct(F.array(F.struct(entity)).alias("mutations")).alias("entityBatchUpdate")).alias("frameworkUpdates")

    def run(c):
        return F.struct(c.alias("text"))

    def renderer(i, text):
        return F.struct(i.alias("commentId"), F.struct(F.array(run(F.col("role")), run(F.lit(": ")), run(text)).alias("runs")).alias("contentText"))

    again = F.struct(F.struct(F.struct(renderer(ident, F.col("text")).alias("commentRenderer")).alias("comment")).alias("commentThreadRenderer"))
    extra = F.struct(renderer(F.lit(None).cast("string"), F.col("text")).alias("commentRenderer"))
    actions = F.struct(F.struct(F.array(again).alias("continuationItems")).alias("reloadContinuationItemsCommand"))
    more = F.struct(F.struct(F.array(extra).alias("continuationItems")).alias("appendContinuationItemsAction"))

    def payload(content):
        both = F.array(F.to_json(actions), F.to_json(more))
        head = F.to_json(F.struct(modern(content)))
        listed = F.concat(F.lit(',"onResponseReceivedEndpoints":['), F.array_join(both, ","), F.lit("]}"))
        return F.concat(F.substring(head, F.lit(1), F.length(head) - 1), listed)

    source = F.when(F.col("role") == "user", payload(F.struct(F.col("text").alias("content")))).when(
        F.col("role") == "assistant", payload(F.col("text"))
    ).otherwise(F.lit("not json"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", source.alias("payload"))


_PAYLOAD_ROWS = """rows AS (
  SELECT conv_id, turn, 0 AS idx, 'c-' || conv_id || '-' || turn AS comment_id, role AS author, text, CAST(turn AS VARCHAR) AS like_count
  FROM conversations WHERE role <> 'system'
  UNION ALL SELECT conv_id, turn, 2, NULL, NULL, role || ': ' || text, NULL FROM conversations WHERE role <> 'system')"""


@query(
    "union_layouts",
    f"""WITH {_PAYLOAD_ROWS} SELECT conv_id, turn, comment_id, author, text, like_count, position FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, idx) AS INTEGER) AS position FROM rows) WHERE position <= 10""",
)
def union_layouts(spark, sf_dir):
    rows = comments.payload_comments(_payloads(spark, sf_dir), ["conv_id", "turn"])
    cut = comments.numbered(rows, ["conv_id"], "turn", 10)
    return cut.select("conv_id", "turn", "comment_id", "author", "text", "like_count", "position")


@query(
    "json_paths",
    f"WITH {_PAYLOAD_ROWS} SELECT conv_id, turn, comment_id, author, text, like_count, '1 day ago' AS published_at FROM rows WHERE idx = 0",
)
def json_paths(spark, sf_dir):
    parsed = _payloads(spark, sf_dir).withColumn("v", F.try_parse_json("payload"))
    rows = parsed.select("conv_id", "turn", F.explode(json_of.modern_comments(F.col("v"))).alias("c"))
    return rows.select("conv_id", "turn", "c.*")


@query(
    "json_in_html",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events""",
)
def json_in_html(spark, sf_dir):
    kind = F.col("event_type")
    html = (
        F.when(kind == "click", F.format_string("<script>var ytInitialData = %s;</script>", "props"))
        .when(kind == "view", F.format_string('<script>window[ "ytInitialData" ] = %s; go()</script>', "props"))
        .when(kind == "error", F.lit("<p>gone</p>"))
        .otherwise(F.col("props"))
    )
    found = json_of.embedded_json(html)
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(found, "$.k", "bigint").alias("k"))
