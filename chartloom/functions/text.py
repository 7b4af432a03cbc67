"""Text functions: keys, cleaning, URLs, templates."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values -----------------------------------------------------------
# Characters a Unicode strip removes at both ends.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
BLANK_KEY = "|"
WATCH_URL = "https://www.youtube.com/watch?v="
PAGE_URL = "https://en.wikipedia.org/wiki/"
VIDEO_ID_PATTERN = r"v=([A-Za-z0-9_-]{6,})"
EMBED_MARKER = r"(?U)^\d*EmbedShare URLCopyEmbedCopy"
CONTRIBUTORS_TAIL = r"(?Ud)\d+ Contributors.*$"
UNKNOWN_YEAR = "UNKNOWN"
AWARD_WORDS = (
    "award", "grammy", "accolade", "honor", "honour", "nomination",
    "nominated", "won", "winning", "ranked", "ranking", "listed",
)
# -----------------------------------------------------------------------------


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def first_nonempty(*cols: Column) -> Column:
    """First value that is neither NULL nor the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def track_key(name: Column, artist: Column) -> Column:
    def side(c):
        return strip(F.coalesce(c, F.lit("")))

    return F.lower(F.concat(side(name), F.lit(BLANK_KEY), side(artist)))


def joinable_key(key: Column) -> Column:
    """The key as used in joins: the blank key matches nothing."""
    return F.nullif(key, F.lit(BLANK_KEY))


def clean_lyrics(c: Column) -> Column:
    c = F.regexp_replace(strip(c), EMBED_MARKER, "")
    c = F.regexp_replace(strip(c), CONTRIBUTORS_TAIL, "")
    c = F.regexp_replace(strip(c), r"\n+", "\n")
    return F.nullif(c, F.lit(""))


def clean_search(c: Column) -> Column:
    c = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?d)\(.*?\)", "")
    c = F.regexp_replace(c, r"(?d)\[.*?\]", "")
    return strip(F.substring_index(c, " - ", 1))


@F.pandas_udf(T.StringType())
def _ascii_fold(texts: pd.Series) -> pd.Series:
    return texts.map(
        lambda t: unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode("ascii"),
        na_action="ignore",
    )


def normalize_text(c: Column) -> Column:
    """Compatibility-decompose, drop non-ASCII, lower, one space between runs.

    Only values that hold a non-ASCII character travel to Python; for the
    others the UDF sees NULL.
    """
    foreign = c.rlike(r"[^\x00-\x7F]")
    ascii_text = F.coalesce(_ascii_fold(F.when(foreign, c)), c)
    return F.trim(F.regexp_replace(F.lower(ascii_text), "[^a-z0-9]+", " "))


def extract_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, VIDEO_ID_PATTERN, 1), F.lit(""))


def watch_url(video_id: Column) -> Column:
    return F.concat(F.lit(WATCH_URL), video_id)


def page_url(title: Column) -> Column:
    """Page address of a title: '_' for ' ', percent-encoded, '/' kept."""
    encoded = F.url_encode(F.replace(title, F.lit(" "), F.lit("_")))
    for seen, wanted in (("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        encoded = F.replace(encoded, F.lit(seen), F.lit(wanted))
    return F.concat(F.lit(PAGE_URL), encoded)


def _resolve_dots(path: Column) -> Column:
    """Fold '.' and '..' segments of an absolute path."""
    parts = F.split(path, "/")
    folded = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1))))
        .otherwise(F.concat(acc, F.array(s))),
    )
    ends_in_dots = F.element_at(parts, -1).isin(".", "..")
    return F.concat(F.array_join(folded, "/"), F.when(ends_in_dots, F.lit("/")).otherwise(F.lit("")))


def absolute_url(base: Column, link: Column) -> Column:
    """Resolve ``link`` against the page address ``base``."""
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    page = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.regexp_replace(F.substring(page, F.length(root) + 1, F.length(page)), r"[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    own_path = F.regexp_replace(link, r"[?#].*$", "")
    own_tail = F.regexp_extract(link, r"([?#].*)$", 1)
    has_dots = own_path.rlike(r"(^|/)\.{1,2}(/|$)")

    def settle(path):
        return F.when(has_dots, _resolve_dots(path)).otherwise(path)

    return (
        F.when(link == "", base)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("#"), F.concat(F.regexp_replace(base, r"#.*$", ""), link))
        .when(link.startswith("?"), F.concat(page, link))
        .when(link.startswith("/"), F.concat(root, settle(own_path), own_tail))
        .otherwise(F.concat(root, settle(F.concat(folder, own_path)), own_tail))
    )


def title_suffix(title: Column) -> Column:
    """Text after the last 'of ', or the unknown marker."""
    tail = strip(F.substring_index(title, "of ", -1))
    return F.when(title.contains("of "), tail).otherwise(F.lit(UNKNOWN_YEAR))


def all_digits(c: Column) -> Column:
    return c.rlike("^[0-9]+$")


def has_award_word(c: Column, words=AWARD_WORDS) -> Column:
    """Substring test, so 'won' also hits 'wonder'."""
    text = F.lower(c)
    return reduce(lambda x, y: x | y, [text.contains(w) for w in words])


def strict_query(name: Column, artist: Column) -> Column:
    return F.format_string('track:"%s" artist:"%s"', name, artist)


def loose_query(name: Column, artist: Column) -> Column:
    return strip(F.concat(F.coalesce(name, F.lit("")), F.lit(" "), F.coalesce(artist, F.lit(""))))


def page_query(name: Column, artist: Column) -> Column:
    return strip(F.concat(name, F.lit(" "), artist, F.lit(" song")))


def label(name: Column, artist: Column) -> Column:
    return F.format_string("%s - %s", name, artist)
