"""Counts, rates and cross-tabulations.  All are plain aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.operators.ordering import add_position


def value_counts(df: DataFrame, column: str, keep_null: bool = False) -> DataFrame:
    rows = df if keep_null else df.filter(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, column: str, n: int = 15) -> DataFrame:
    return value_counts(df, column).orderBy(F.desc("n"), F.asc(column)).limit(n)


def crosstab(df: DataFrame, row: str, column: str, classes: list[str]) -> DataFrame:
    """Counts per row value and class, with the total over all classes.

    The classes are given, so no job looks them up first.
    """
    counts = [F.count_if(F.col(column) == c).alias(c) for c in classes]
    return df.filter(F.col(row).isNotNull()).groupBy(row).agg(*counts, F.count(F.col(column)).alias("total"))


def rate(hit: Column) -> Column:
    """Share of rows, in percent."""
    return F.try_divide(100 * F.count_if(hit), F.count(F.lit(1)))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULLs per column, one pass, one row per column."""
    cols = columns or df.columns
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in cols])
    return one.select(F.inline(pairs))


def cleaning_audit(df: DataFrame, valid: Column) -> DataFrame:
    ok = F.coalesce(valid, F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(~ok).alias("rows_removed"),
        F.count_if(ok).alias("rows_after"),
    )


def id_batches(df: DataFrame, ident: str, order: str, size: int) -> DataFrame:
    """Distinct ids in order of first appearance, in batches of ``size``."""
    ids = df.filter(F.col(ident).isNotNull()).groupBy(ident).agg(F.min(order).alias("__first"))
    placed = add_position(ids, "__first", into="__pos", ties=[ident])
    return (
        placed.withColumn("batch", F.floor((F.col("__pos") - 1) / size).cast("bigint"))
        .groupBy("batch")
        .agg(F.array_sort(F.collect_list(F.struct("__pos", ident))).alias("__l"))
        .select("batch", F.transform("__l", lambda x: x[ident]).alias("ids"))
    )
