"""Fuzzy text similarity and candidate scores."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values -----------------------------------------------------------
ARTIST_THRESHOLD = 70
SONG_MARK, SONG_WEIGHT = "(song", 2.5
TITLE_WEIGHT, ARTIST_TITLE_WEIGHT, ARTIST_SNIPPET_WEIGHT = 3.0, 1.0, 0.5
# -----------------------------------------------------------------------------


def _common_length(a: str, b: str) -> int:
    """Longest common subsequence, one bit per character of ``a``."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    open_bits = full
    for ch in b:
        hit = open_bits & where.get(ch, 0)
        open_bits = ((open_bits + hit) | (open_bits - hit)) & full
    return len(a) - open_bits.bit_count()


@F.pandas_udf(T.IntegerType())
def lcs_length(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else _common_length(x, y) for x, y in zip(a, b)], dtype="Int32")


def words(c: Column) -> Column:
    """Sorted distinct words: Latin-1 letters dropped, other signs to spaces."""
    plain = F.lower(F.regexp_replace(c, r"[\x80-\xFF]", ""))
    spaced = F.regexp_replace(plain, r"(?U)\W", " ")
    return F.array_sort(F.array_distinct(F.filter(F.split(spaced, " +"), lambda w: w != "")))


def word_set_ratio(wa: Column, wb: Column, above: int | None = None) -> Column:
    """Similarity of two results of ``words``, 0 to 100.

    With ``s`` the length of the joined common words and ``x``, ``y`` those of
    the two remainders, the three pairings share the prefix of length ``s``, so
    only the remainders need an LCS.  It has no more letters than either remainder has
    in common with the letters of the other; where even that many could not beat the
    two other pairings, it is not computed.  With ``above``, scores that cannot pass it
    may come out lower than they are.
    """
    common = F.array_join(F.array_intersect(wa, wb), " ")
    rest_a = F.array_join(F.array_except(wa, wb), " ")
    rest_b = F.array_join(F.array_except(wb, wa), " ")
    s, x, y = F.length(common), F.length(rest_a), F.length(rest_b)
    gap = F.when(s > 0, 1).otherwise(0)
    whole_a, whole_b = s + gap + x, s + gap + y

    def ratio(distance, total):
        return 100 - 100 * distance / F.nullif(total, F.lit(0))


    def shared(one, other):
        """Letters of a text that the other has at all."""
        return F.length(one) - F.length(F.call_function("translate", one, other, F.lit("")))

    most = F.least(shared(rest_a, rest_b), shared(rest_b, rest_a))
    sure = F.when(s == 0, F.lit(0.0)).otherwise(F.greatest(ratio(gap + x, s + whole_a), ratio(gap + y, s + whole_b)))
    reach = ratio(x + y - 2 * most, whole_a + whole_b)
    open_ = (x > 0) & (y > 0) & (reach > sure)
    if above is not None:
        open_ = open_ & (F.bround(reach, 0) > above)
    compared = lcs_length(F.when(open_, rest_a), F.when(open_, rest_b))
    best = F.when(open_, F.greatest(sure, ratio(x + y - 2 * F.coalesce(compared, F.lit(0)), whole_a + whole_b))).otherwise(sure)
    return (
        F.when((F.coalesce(F.size(wa), F.lit(0)) <= 0) | (F.coalesce(F.size(wb), F.lit(0)) <= 0), 0)
        .when((s > 0) & ((x == 0) | (y == 0)), 100)
        .otherwise(F.bround(best, 0).cast("int"))
    )


def token_set_ratio(a: Column, b: Column) -> Column:
    """Token-set similarity of two texts."""
    return word_set_ratio(words(a), words(b))


def page_score(title_raw: Column, title: Column, snippet: Column, name: Column, artist: Column) -> Column:
    """Weighted hits; all but ``title_raw`` are normalised texts."""

    def points(hit, weight):
        return F.when(hit, F.lit(weight)).otherwise(F.lit(0.0))

    def within(part, text):
        return (part != "") & text.contains(part)

    return (
        points(F.lower(title_raw).contains(SONG_MARK), SONG_WEIGHT)
        + points(within(name, title), TITLE_WEIGHT)
        + points(within(artist, title), ARTIST_TITLE_WEIGHT)
        + points(within(artist, snippet), ARTIST_SNIPPET_WEIGHT)
    )
