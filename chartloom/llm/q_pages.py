"""Queries on captured pages."""

from __future__ import annotations

from chartloom.llm import revisits
from chartloom.llm.common import table
from chartloom.llm.queries import query


@query("op2_revisits", revisits.SQL)
def op2_revisits(spark, sf_dir):
    found = revisits.resolved(revisits.captures(table(spark, sf_dir, "pages")))
    return found.withColumn("headers", revisits.header_text())
