"""Registered queries: each operator on the given tables, with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a (spark, sf_dir) function, and its SQL when there is one."""

    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return keep


def load_all() -> None:
    from chartloom.catalog import changes, clips, joins, keyed, matching, pages, records, reports, streams, texts  # noqa: F401
