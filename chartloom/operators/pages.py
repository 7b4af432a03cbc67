"""Rows out of captured pages.

Parsing is a narrow map over the page table; all that follows (links resolved,
words filtered, repeats dropped) is column work and joins.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf

from chartloom.functions import html
from chartloom.functions.text import AWARD_WORDS, absolute_url, all_digits, has_award_word, strip, title_suffix
from chartloom.operators.keyed import first_wins


# Parsed rows that a task holds at a time, pages apart.
_ROWS_AT_ONCE = 2000


def _mapper(columns: list[str], rows_of):
    names = ["page_id", "url", *columns]

    def run(batches):
        for pdf in batches:
            out = []
            for page, url, source in zip(pdf["page_id"], pdf["url"], pdf["html"]):
                out += [(page, url, *row) for row in rows_of(html.parse(source))]
                if len(out) >= _ROWS_AT_ONCE:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            yield pd.DataFrame(out, columns=names)

    return run


def spread(pages: DataFrame) -> DataFrame:
    """pages dealt to as many tasks as a shuffle has.

    Parsing takes far longer than reading: a file of few megabytes is read by few tasks
    and would be parsed by them alone.
    """
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pages.repartition(n, F.xxhash64("page_id", "url", "html"))


# An attribute value with a character reference could spell a class in another way.
_SPELT = r"(?i)class\s*=\s*[\"']?[^\"'>]*&"


def _extract(pages: DataFrame, fields: str, rows_of, signs: frozenset[str] = frozenset()) -> DataFrame:
    """Parsed rows of the pages; only those that hold all signs are parsed."""
    columns = [part.split()[0] for part in fields.split(",")]
    kinds = dict(pages.dtypes)
    source = pages.select("page_id", "url", "html")
    if signs:
        held = reduce(and_, [F.col("html").contains(sign) for sign in sorted(signs)])
        source = source.filter(held | F.col("html").rlike(_SPELT))
    schema = f"page_id {kinds['page_id']}, url string, {fields}"
    return source.mapInPandas(_mapper(columns, rows_of), schema)


def _titled_rows(root):
    title = html.heading(root)
    for row in html.chart_rows(root):
        yield (title, *row)


def as_entries(rows: DataFrame) -> DataFrame:
    """Chart entries of parsed rows: name, artist, year, place, link."""
    return rows.select(
        "page_id",
        "table_no",
        "row_no",
        "name",
        "artist",
        F.coalesce(title_suffix(F.col("title")), F.lit("UNKNOWN")).alias("year"),
        "place",
        absolute_url(F.col("url"), F.col("href")).alias("link"),
    )


def chart_rows(pages: DataFrame) -> DataFrame:
    """One row per chart entry: name, artist, year, place, link."""
    return as_entries(_extract(spread(pages.select("page_id", "url", "html")), *_cells("chart"), html.CHART_CLASSES))


def _cells(kind: str) -> tuple[str, object]:
    """Row shape and parser of a kind of rows."""
    shapes = {
        "chart": ("title string, table_no int, row_no int, place string, name string, href string, artist string", _titled_rows),
        "blocks": ("layout int, block_no int, text string", html.text_blocks),
    }
    if kind not in shapes:
        raise ValueError(f"kind of rows is one of {sorted(shapes)}")
    return shapes[kind]


class PageRows:
    """Table function page_rows(html, kind): the rows of one page; the kind is a constant that gives the columns."""

    @staticmethod
    def analyze(source: AnalyzeArgument, kind: AnalyzeArgument) -> AnalyzeResult:
        if not kind.isConstantExpression or kind.value is None:
            raise ValueError("kind of rows must be a constant")
        kinds = {"int": T.IntegerType(), "string": T.StringType()}  # no session parses schemas where this runs
        fields = [part.split() for part in _cells(kind.value)[0].split(",")]
        return AnalyzeResult(T.StructType([T.StructField(name, kinds[of]) for name, of in fields]))

    def eval(self, source: str, kind: str):
        yield from _cells(kind)[1](html.parse(source))


def register_page_rows(spark: SparkSession) -> None:
    """Make page_rows known to SQL: SELECT ... FROM pages, LATERAL page_rows(html, 'chart')."""
    spark.udtf.register("page_rows", udtf(PageRows, useArrow=True))


def _all_links(root):
    return html.list_links(root, everywhere=True)


def page_links(pages: DataFrame, everywhere: bool = False) -> DataFrame:
    """List links with their absolute address and an all-digits flag."""
    rows = _extract(pages, "link_no int, href string, label string", _all_links if everywhere else html.list_links)
    return rows.select(
        "page_id",
        "link_no",
        "label",
        absolute_url(F.col("url"), F.col("href")).alias("link"),
        all_digits(strip(F.col("label"))).alias("is_year"),
    )


def year_links(pages: DataFrame) -> DataFrame:
    return page_links(pages).filter("is_year").drop("is_year")


def text_blocks(pages: DataFrame) -> DataFrame:
    return _extract(pages, *_cells("blocks"), frozenset({html.CONTENT_CLASS})).drop("url")


def distinct_blocks(blocks: DataFrame) -> DataFrame:
    """First occurrence of a text within its page."""
    return first_wins(blocks, ["page_id", "text"], ["layout", "block_no"])


def award_blocks(pages: DataFrame, words=AWARD_WORDS) -> DataFrame:
    return distinct_blocks(text_blocks(pages).filter(has_award_word(F.col("text"), words)))
