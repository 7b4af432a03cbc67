"""One or a few rows per key: last wins, first wins, top N, argmax."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _list(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def _order(cols) -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in _list(cols)]
    return cols[0] if len(cols) == 1 else F.struct(*cols)


def _reduce(df: DataFrame, keys, order, pick) -> DataFrame:
    keys = _list(keys)
    rest = [F.col(c) for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(pick(F.struct(*rest), _order(order)).alias("__r")).select(*keys, "__r.*")


def last_wins(df: DataFrame, keys, order) -> DataFrame:
    """Last row per key.  An aggregate, so copies of a hot key merge map-side."""
    return _reduce(df, keys, order, F.max_by)


def first_wins(df: DataFrame, keys, order) -> DataFrame:
    """First row per key."""
    return _reduce(df, keys, order, F.min_by)


def top_n(df: DataFrame, keys, order, n: int, into: str | None = None) -> DataFrame:
    """First ``n`` rows per key.

    The filter on the rank lets Spark cut every key to ``n`` rows before the
    exchange, so a hot key never reaches one task whole.
    """
    w = W.partitionBy(*_list(keys)).orderBy(*_list(order))
    name = into or "__rank"
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return out if into else out.drop(name)


def collect_top(df: DataFrame, keys, order: list, n: int, entry: list[Column], into: str) -> DataFrame:
    """First ``n`` rows per key as an ordered array of structs."""
    keys = _list(keys)
    cut = top_n(df, keys, order, n, into="__rank")
    lists = cut.groupBy(*keys).agg(F.collect_list(F.struct("__rank", F.struct(*entry).alias("e"))).alias("__l"))
    return lists.select(*keys, F.transform(F.array_sort("__l"), lambda x: x["e"]).alias(into))


def argmax_first(df: DataFrame, keys, score: Column, position: str) -> DataFrame:
    """Best-scored row per key, the earliest one on a tie.

    ``position`` may be any sortable column, a struct included.
    """
    return first_wins(df, keys, [score.isNull(), -score, F.col(position)])


def first_with_rows(candidates: DataFrame, keys, index: str, count: Column, tries: int = 4) -> DataFrame:
    """The first of the first ``tries`` candidates that has rows."""
    return first_wins(candidates.filter((count > 0) & (F.col(index) < tries)), keys, index)


def complete_prefix(df: DataFrame, order: str, complete: Column) -> DataFrame:
    """Rows ahead of the first incomplete one.

    One number (the first gap) comes from a plain aggregate as a scalar subquery,
    instead of a running sum through one task.
    """
    gap = df.agg(F.min(F.when(~F.coalesce(complete, F.lit(False)), F.col(order))).alias("gap"))
    return df.filter(F.coalesce(F.col(order) < gap.scalar(), F.lit(True)))
