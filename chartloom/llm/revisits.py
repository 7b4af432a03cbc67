"""Not-modified revisits: each joined to the latest earlier full response of its URL.

Records carry url, time, status, headers and an id.  URLs are brought to a canonical
form.  Within a URL the records are in order of time, then id; a revisit (status 304)
takes the latest full response (status 200) before it.  Validators decide: entity
tags are compared weakly if both sides have one, else the dates of last change; a
revisit without validators in common is taken as it is and marked.  Headers that a
304 may bring up to date replace those of the response; the others stay.

A URL of any size is cut into stretches of time by quantiles of all records, so no
task orders more than a stretch of a URL.  Each stretch hands its last response on.

NULL or empty URLs match only themselves, never each other.  NULL times come first.
Of repeated records any may serve, with the same content.  Names of headers are
compared in lower case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartloom.llm.common import stored
from chartloom.llm.graph import lookup

STRETCHES = 200
# Headers that a 304 response may update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
_TRACKING = r"(?:utm_[a-z]+|ref|gclid|fbclid)"


def canonical(url: str | Column) -> Column:
    """Lower-case host without www or port 80/443, no scheme, fragment, tracking terms or closing slash."""
    c = F.trim(F.col(url) if isinstance(url, str) else url)
    bare = F.regexp_replace(F.regexp_replace(c, "#.*$", ""), "^(?i)[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), r"^www\.|:(?:80|443)$", "")
    rest = F.regexp_extract(bare, "^[^/?]*(.*)$", 1)
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^?]*", 0), "/+$", "")
    terms = F.filter(
        F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&"), lambda t: (t != "") & ~t.rlike(f"^{_TRACKING}(=|$)")
    )
    query = F.when(F.size(terms) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(terms), "&"))).otherwise("")
    return F.concat(host, path, query)


def _lower(headers: str) -> Column:
    """Headers by lower-case name; of names that differ in case only, the greatest value counts."""

    def name(e: Column) -> Column:
        return F.lower(F.trim(e["key"]))

    def value(of: Column) -> Column:
        return F.array_max(F.transform(F.filter(F.map_entries(headers), lambda e: name(e) == of), lambda e: e["value"]))

    names = F.array_distinct(F.transform(F.map_entries(headers), name))
    return F.coalesce(F.map_from_arrays(names, F.transform(names, value)), F.create_map().cast("map<string,string>"))


def _tag(headers: Column) -> Column:
    return F.regexp_replace(F.trim(headers["etag"]), "^[Ww]/", "")


def resolved(records: DataFrame, stretches: int = STRETCHES) -> DataFrame:
    """Revisits with url_key, response_id, state and merged headers.

    records: record_id, url, time (any ordered type), status int, headers map<string,string>.
    state is confirmed, unchecked, changed or missing; headers are merged for the
    first two, the revisit's own for the others.
    """
    own = records.select("record_id", "url", "time", "status", _lower("headers").alias("headers")).filter("status IN (200, 304)")
    # Rows without a URL get a key of their own.
    key = F.when(F.coalesce(F.col("url"), F.lit("")) != "", canonical("url"))
    kept = stored(own.withColumn("url_key", key).withColumn("tick", F.coalesce(F.col("time").cast("double"), F.lit(float("-inf")))), "records")
    cuts = kept.agg(F.percentile_approx("tick", [i / stretches for i in range(1, stretches)], 10_000).alias("c")).first()["c"] or []
    cuts = sorted(set(cuts))
    at = F.size(F.filter(F.array(*(F.lit(c) for c in cuts)), lambda c: c <= F.col("tick"))) if cuts else F.lit(0)
    placed = kept.withColumn("stretch", at).withColumn(
        "response", F.when(F.col("status") == 200, F.struct("tick", "record_id", "headers"))
    )
    keyed = placed.filter("url_key IS NOT NULL")
    last = keyed.filter("response IS NOT NULL").groupBy("url_key", "stretch").agg(
        F.max_by("response", F.struct("tick", "record_id")).alias("own_last")
    )
    full = keyed.select("url_key", "stretch").distinct().join(last, ["url_key", "stretch"], "left")
    by_url = W.partitionBy("url_key").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    carried = full.withColumn("carried", F.last("own_last", ignorenulls=True).over(by_url)).select("url_key", "stretch", "carried")
    local = W.partitionBy("url_key", "stretch").orderBy("tick", "record_id").rowsBetween(W.unboundedPreceding, -1)
    near = keyed.withColumn("near", F.last("response", ignorenulls=True).over(local)).filter("status = 304")
    found = near.join(carried, ["url_key", "stretch"]).withColumn("hit", F.coalesce("near", "carried")).drop("near", "carried", "response")
    alone = placed.filter("url_key IS NULL AND status = 304").drop("response")
    every = found.unionByName(alone, allowMissingColumns=True)
    a, b = F.col("headers"), F.col("hit.headers")
    state = (
        F.when(F.col("hit").isNull(), "missing")
        .when(_tag(a).isNotNull() & _tag(b).isNotNull(), F.when(_tag(a) == _tag(b), "confirmed").otherwise("changed"))
        .when(
            a["last-modified"].isNotNull() & b["last-modified"].isNotNull(),
            F.when(a["last-modified"] == b["last-modified"], "confirmed").otherwise("changed"),
        )
        .otherwise("unchecked")
    )
    news = F.map_filter(a, lambda k, v: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(b, lambda k, v: ~F.map_contains_key(news, k)), news)
    return every.withColumn("state", state).select(
        "record_id",
        "url_key",
        "time",
        F.col("hit.record_id").alias("response_id"),
        "state",
        F.when(F.col("state").isin("confirmed", "unchecked"), merged).otherwise(a).alias("headers"),
    )


def with_payload(found: DataFrame, records: DataFrame, payload: str) -> DataFrame:
    """Resolved revisits with the payload of their response; changed and missing ones have none."""
    bodies = records.filter("status = 200").select(F.col("record_id").alias("response_id"), payload).dropDuplicates(["response_id"])
    good = found.withColumn("response_id", F.when(F.col("state").isin("confirmed", "unchecked"), F.col("response_id")))
    return lookup(good, bodies, "response_id", "left")


def header_text(headers: str = "headers") -> Column:
    pairs = F.transform(F.map_entries(headers), lambda e: F.concat_ws(": ", e["key"], e["value"]))
    return F.array_join(F.array_sort(pairs), "\n")


def captures(pages: DataFrame) -> DataFrame:
    """Capture records from stored pages: each page as a full response and one later request for it.

    The first capture is at page_id; the request comes `gap` ids later, where gap
    follows from a number made of its id and length, so other captures of the URL may lie between.
    Its validators are those of the page it was made for.
    """
    html = F.coalesce("html", F.lit(""))
    h = (F.col("page_id") * 7919 + F.length(html)) % 10007
    tag, changed = F.concat(F.lit('"'), F.md5(html), F.lit('"')), F.concat(F.lit("day "), (h % 365).cast("string"))
    gap = (h % 1000) + 1
    base = pages.select("page_id", "url", h.alias("h"), tag.alias("tag"), changed.alias("changed"), gap.alias("gap"))
    full = base.select(
        (F.col("page_id") * 2).alias("record_id"),
        "url",
        F.col("page_id").alias("time"),
        F.lit(200).alias("status"),
        F.map_filter(
            F.create_map(
                F.lit("ETag"), F.when(F.col("h") % 4 > 0, F.col("tag")),
                F.lit("Last-Modified"), F.when(F.col("h") % 3 > 0, F.col("changed")),
                F.lit("Content-Type"), F.lit("text/html"),
                F.lit("Cache-Control"), F.lit("max-age=60"),
            ),
            lambda k, v: v.isNotNull(),
        ).alias("headers"),
    )
    again = base.select(
        (F.col("page_id") * 2 + 1).alias("record_id"),
        "url",
        (F.col("page_id") + F.col("gap")).alias("time"),
        F.lit(304).alias("status"),
        F.map_filter(
            F.create_map(
                F.lit("etag"), F.when(F.col("h") % 5 > 0, F.concat(F.lit("W/"), F.col("tag"))),
                F.lit("last-modified"), F.when(F.col("h") % 2 > 0, F.col("changed")),
                F.lit("Cache-Control"), F.concat(F.lit("max-age="), F.col("gap").cast("string")),
                F.lit("Content-Length"), F.lit("0"),
            ),
            lambda k, v: v.isNotNull(),
        ).alias("headers"),
    )
    return full.unionByName(again)


SQL = r"""WITH base AS (
  SELECT page_id, url, (page_id * 7919 + length(coalesce(html, ''))) % 10007 AS h, '"' || md5(coalesce(html, '')) || '"' AS tag,
    regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM pages),
keyed AS (
  SELECT *, regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), '^www\.|:(?:80|443)$', '', 'g')
    || regexp_replace(regexp_extract(regexp_extract(bare, '^[^/?]*(.*)$', 1), '^[^?]*'), '/+$', '') AS place,
    list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
      lambda t: t <> '' AND NOT regexp_matches(t, '^(?:utm_[a-z]+|ref|gclid|fbclid)(=|$)'))) AS terms FROM base),
pages_of AS (
  SELECT *, CASE WHEN url <> '' THEN
    place || CASE WHEN len(terms) > 0 THEN '?' || array_to_string(terms, '&') ELSE '' END END AS url_key FROM keyed),
answers AS (
  SELECT page_id * 2 AS record_id, url_key, page_id AS t, CASE WHEN h % 4 > 0 THEN tag END AS etag,
    CASE WHEN h % 3 > 0 THEN 'day ' || h % 365 END AS changed FROM pages_of),
asked AS (
  SELECT page_id * 2 + 1 AS record_id, url_key, page_id + h % 1000 + 1 AS t, h % 1000 + 1 AS gap,
    CASE WHEN h % 5 > 0 THEN tag END AS etag, CASE WHEN h % 2 > 0 THEN 'day ' || h % 365 END AS changed FROM pages_of),
joined AS (
  SELECT q.*, r.record_id AS response_id, r.etag AS r_etag, r.changed AS r_changed
  FROM asked q LEFT JOIN answers r ON q.url_key = r.url_key AND (r.t < q.t OR (r.t = q.t AND r.record_id < q.record_id))
  QUALIFY row_number() OVER (PARTITION BY q.record_id ORDER BY r.t DESC NULLS LAST, r.record_id DESC) = 1),
judged AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'missing'
    WHEN etag IS NOT NULL AND r_etag IS NOT NULL THEN CASE WHEN etag = r_etag THEN 'confirmed' ELSE 'changed' END
    WHEN changed IS NOT NULL AND r_changed IS NOT NULL
      THEN CASE WHEN changed = r_changed THEN 'confirmed' ELSE 'changed' END
    ELSE 'unchecked' END AS state FROM joined)
SELECT record_id, url_key, t AS time, response_id, state, array_to_string(list_sort(list_filter(
  CASE WHEN state IN ('confirmed', 'unchecked') THEN
    ['etag: ' || coalesce('W/' || etag, r_etag), 'last-modified: ' || coalesce(changed, r_changed),
     'content-type: text/html', 'cache-control: max-age=' || gap]
  ELSE ['etag: W/' || etag, 'last-modified: ' || changed, 'cache-control: max-age=' || gap, 'content-length: 0'] END,
  lambda x: x IS NOT NULL)), chr(10)) AS headers FROM judged"""
