import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chartloom.functions.similarity import _common_length, page_score, token_set_ratio, word_set_ratio, words


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def pairwise(a, b):
    return 200 * lcs(a, b) / (len(a) + len(b)) if a or b else 0.0


def ratio(a, b):
    """By the definition: the best of three pairings of joined sorted words."""

    def words(t):
        return set(re.sub(r"\W", " ", "".join(c for c in t if not 128 <= ord(c) < 256).lower()).split())

    wa, wb = words(a), words(b)
    if not wa or not wb:
        return 0
    common, ra, rb = (" ".join(sorted(s)) for s in (wa & wb, wa - wb, wb - wa))
    if common and (not ra or not rb):
        return 100
    sa, sb = f"{common} {ra}".strip(), f"{common} {rb}".strip()
    best = [pairwise(sa, sb)] + ([pairwise(common, sa), pairwise(common, sb)] if common else [])
    return round(max(best))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abc ", max_size=20), st.text(alphabet="abc ", max_size=20))
def test_common_length(a, b):
    assert _common_length(a, b) == lcs(a, b)


NAMES = [
    "The Beatles", "beatles, the", "Beatles", "Rolling Stones", "Jay-Z & Kanye West", "kanye west", "Beyoncé", "Beyonce",
    "", "!!!", "AC/DC", "ac dc", "red ring", "small ring", "blue widget", "red widget", "Earth Wind and Fire",
    "Earth, Wind & Fire", "under_score", "ŁÓDŹ x",
]


def test_token_set_ratio(spark):
    pairs = [(a, b) for a in NAMES for b in NAMES]
    df = spark.createDataFrame(pairs, "a string, b string").repartition(3)
    got = {(r.a, r.b): r.s for r in df.select("a", "b", token_set_ratio(F.col("a"), F.col("b")).alias("s")).collect()}
    assert got == {p: ratio(*p) for p in pairs}
    assert all(got[a, b] == got[b, a] and 0 <= got[a, b] <= 100 for a, b in pairs)


def test_token_set_ratio_null(value):
    assert value(token_set_ratio, None, "x") == 0


@pytest.mark.parametrize(
    "args, score",
    [
        (("Hello (Song)", "hello song", "by ann", "hello", "ann"), 6.0),
        (("Ann hello", "ann hello", "", "hello", "ann"), 4.0),
        (("x", "x", "y", "", ""), 0.0),
    ],
)
def test_page_score(value, args, score):
    assert value(page_score, *args) == score


def test_scores_above_a_floor_are_exact(spark):
    """With a floor, scores above it are as without; those that cannot pass it stay at or below it."""
    import random

    rng = random.Random(3)
    parts = ["small", "ring", "ringo", "red", "blue bolt", "bolts", "a", "widget", "wdget", "x1"]
    rows = [(" ".join(rng.choices(parts, k=rng.randint(0, 4))), " ".join(rng.choices(parts, k=rng.randint(0, 4)))) for _ in range(400)]
    df = spark.createDataFrame(rows, "a string, b string").select("a", "b", words(F.col("a")).alias("wa"), words(F.col("b")).alias("wb"))
    out = df.select("a", "b", word_set_ratio(F.col("wa"), F.col("wb")).alias("s"), word_set_ratio(F.col("wa"), F.col("wb"), 70).alias("f"))
    for r in out.collect():
        assert r.s == ratio(r.a, r.b)
        assert r.f == r.s if r.s > 70 else r.f <= r.s
