"""The registered queries of the corpus operators, each with its SQL if it has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return keep


def load_all() -> None:
    from chartloom.llm import q_models, q_pages, q_pairs, q_sets, q_text  # noqa: F401
