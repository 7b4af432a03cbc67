import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from urllib.parse import quote, urljoin

from chartloom.functions import text


@pytest.mark.parametrize(
    "name, artist, key",
    [
        ("\t\xa0Blue Moon ", "THE Marcels　", "blue moon|the marcels"),
        (None, "x", "|x"),
        (" ", "\n", "|"),
        (None, None, "|"),
        ("İ", "ΑΣ", "i̇|ας"),
        ("a\x1f", "b", "a|b"),
    ],
)
def test_track_key(value, name, artist, key):
    assert value(text.track_key, name, artist) == key


def test_blank_key_joins_nothing(value):
    assert value(text.joinable_key, "|") is None
    assert value(text.joinable_key, "a|") == "a|"


def test_strip_is_the_unicode_strip(spark):
    chars = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c, f"{c}x{c}") for c in chars], "c string, t string")
    got = {r.c: r.s for r in df.select("c", text.strip(df.t).alias("s")).collect()}
    assert {c for c in chars if got[c] == "x"} == {c for c in chars if c.isspace()}


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("12EmbedShare URLCopyEmbedCopy la la", "la la"),
        ("la\n12EmbedShare URLCopyEmbedCopy\nla", "la\n12EmbedShare URLCopyEmbedCopy\nla"),
        ("one\n\n\ntwo\n3 Contributors and the rest", "one\ntwo"),
        ("one\n3 Contributors x\ntwo", "one\n3 Contributors x\ntwo"),
        ("a\r\n\n\nb", "a\r\nb"),
        ("\n \n", None),
        ("", None),
        (None, None),
    ],
)
def test_clean_lyrics(value, raw, clean):
    assert value(text.clean_lyrics, raw) == clean


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("Hey (Live (1999)) Jude", "Hey ) Jude"),
        ("Song [x] - Remaster - 2009", "Song"),
        ("a (b\nc) d", "a (b\nc) d"),
        ("", ""),
        (None, ""),
        (" - x", ""),
    ],
)
def test_clean_search(value, raw, clean):
    assert value(text.clean_search, raw) == clean


def _normal(t):
    ascii_text = unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode("ascii").lower()
    return " ".join("".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in ascii_text).split())


@pytest.mark.parametrize("raw", ["Straße", "Bjørn", "ﬁne ½", "Beyoncé—Déjà Vu!", "plain_text", "...", "日本 x"])
def test_normalize(value, raw):
    assert value(text.normalize_text, raw) == _normal(raw)


def test_normalize_null(value):
    assert value(text.normalize_text, None) is None


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=30), min_size=1, max_size=20))
def test_normalize_any_text(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(2)
    for row in df.select("t", text.normalize_text(df.t).alias("n")).collect():
        assert row.n == _normal(row.t)


@pytest.mark.parametrize(
    "url, vid",
    [
        ("https://www.youtube.com/watch?v=dQw4w9WgXcQ&t=1", "dQw4w9WgXcQ"),
        ("https://v.example/?v=short", None),
        ("no id", None),
        (None, None),
    ],
)
def test_extract_id(value, url, vid):
    assert value(text.extract_id, url) == vid


@pytest.mark.parametrize("title", ["AC/DC (band)", "What's ~ *up*?", "a b+c & d", "Été"])
def test_page_url(value, title):
    assert value(text.page_url, title) == "https://en.wikipedia.org/wiki/" + quote(title.replace(" ", "_"))


@pytest.mark.parametrize(
    "link",
    ["/wiki/A", "//cdn.example/x", "http://o.example/y?z", "b.html", "../c", "./d/../e", "?q=1", "#frag", "", "/a/../b/./c", "mailto:x@y"],
)
@pytest.mark.parametrize("base", ["https://en.example.org/w/x/page?p=1#t", "http://h.example"])
def test_absolute_url(value, base, link):
    assert value(text.absolute_url, base, link) == urljoin(base, link)


def test_title_suffix(value):
    assert value(text.title_suffix, "Top of the singles of 1970 ") == "1970"
    assert value(text.title_suffix, "Singles 1970") == "UNKNOWN"


def test_award_words(value):
    assert value(text.has_award_word, "A WONDER") is True
    assert value(text.has_award_word, "nothing here") is False


def test_first_nonempty(value):
    assert value(text.first_nonempty, "", "b") == "b"
    assert value(text.first_nonempty, None, "") is None
    assert value(text.strict_query, "a", "b") == 'track:"a" artist:"b"'
    assert value(text.loose_query, " a", None) == "a"
