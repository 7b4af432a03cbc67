"""Numbers, NULL handling, arrays and status text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartloom.functions.text import extract_id, first_nonempty, watch_url

# ---- fixed values -----------------------------------------------------------
MAX_COMMENTS = 15
YEAR_WINDOW = 4
NEAR_YEAR_WINDOW = 5
STATUS_CLASSES = (
    "Success (Lyrics Found)",
    "Found (No Lyrics)",
    "Ambiguous Match",
    "Song Not Found",
    "Error / Pending",
)
# -----------------------------------------------------------------------------


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def iso_text(ts: Column) -> Column:
    """ISO text of a timestamp; the fraction appears only when there is one."""
    text = F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))
    return F.when(text.contains("."), F.rpad(text, 26, "0")).otherwise(text)


def to_number(text: Column) -> Column:
    """Lenient number: NULL for anything that is not a finite number."""
    x = text.try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def to_int(text: Column) -> Column:
    return to_number(text).cast("int")


def to_int_or_zero(text: Column) -> Column:
    return F.coalesce(to_int(text), F.lit(0))


def clamp_comment_limit(n: Column) -> Column:
    return F.least(F.greatest(n, F.lit(0)), F.lit(MAX_COMMENTS))


def comment_limit(n: int) -> int:
    return min(max(n, 0), MAX_COMMENTS)


def year_score(a: Column, b: Column) -> Column:
    """100 within four years, 50 within five, else 0; a missing year gives 0."""
    gap = F.abs(a - b)
    return (
        F.when(a == 0, 0)
        .when(gap <= YEAR_WINDOW, 100)
        .when(gap <= NEAR_YEAR_WINDOW, 50)
        .otherwise(0)
    )


def status_class(c: Column) -> Column:
    return (
        F.when(c.isNull(), STATUS_CLASSES[4])
        .when(c.startswith("Success"), STATUS_CLASSES[0])
        .when(c.contains("Lyrics Empty"), STATUS_CLASSES[1])
        .when(c.contains("Song Not Found"), STATUS_CLASSES[3])
        .when(c.contains("Ambiguous"), STATUS_CLASSES[2])
        .when(c.contains("Error"), STATUS_CLASSES[4])
        .otherwise("Other")
    )


def needs_work(status: Column, retry_errors: bool = True) -> Column:
    pending = status.isNull()
    return pending | status.contains("Error") if retry_errors else pending


def drop_empty(c: Column) -> Column:
    return F.filter(c, lambda x: F.coalesce(x != "", F.lit(False)))


def or_empty(c: Column, like: str = "array<string>") -> Column:
    return F.coalesce(c, F.array().cast(like))


def head_of(c: Column, n) -> Column:
    return F.slice(c, 1, n)


def is_filled(struct: Column, fields: list[str]) -> Column:
    """True when at least one field of the struct is set."""
    return F.coalesce(*[F.when(struct[f].isNotNull(), F.lit(True)) for f in fields], F.lit(False))


def missing_list(**present: Column) -> Column:
    """Names of the fields whose flag is false, in the order given."""
    return F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in present.items()])
    )


def candidate_list(candidates: Column, single_id: Column, single_url: Column) -> Column:
    """Candidates with an id, else the single id/url pair, else an empty array."""

    def entry(vid, url):
        return F.struct(vid.alias("youtube_id"), first_nonempty(url, watch_url(vid)).alias("youtube_url"))

    def with_id(c):
        return first_nonempty(c["youtube_id"], extract_id(c["youtube_url"]))

    shape = "array<struct<youtube_id:string,youtube_url:string>>"
    listed = F.transform(
        F.filter(or_empty(candidates, shape), lambda c: with_id(c).isNotNull()),
        lambda c: entry(with_id(c), c["youtube_url"]),
    )
    single = first_nonempty(single_id, extract_id(single_url))
    return (
        F.when(F.size(listed) > 0, listed)
        .when(single.isNotNull(), F.array(entry(single, single_url)))
        .otherwise(F.array().cast(shape))
    )
