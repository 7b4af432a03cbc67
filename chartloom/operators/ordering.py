"""Row order on Spark: positions, slices, first rows.

Order is always a column.  Positions come from a range partitioning by key, order
and a hash of the row, which spreads equal orders too: the sorted partitions are
written once, numbered as they are written, and the numbers are shifted by where a
key's rows begin.  No task sorts more than a partition, whatever the size of a key
or the number of equal orders.  The first rows are found without sorting the table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.operators.lookups import left_lookup
from chartloom.session import new_workspace

# A range of at most so many rows is collected (order and hash only) to find its n-th.
_SMALL_RANGE = 4096


def _row_hash(df: DataFrame) -> Column:
    """96 bits that tell rows apart; maps count by their sorted entries."""
    parts = []
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        if isinstance(field.dataType, T.MapType) and "map<" not in kind[4:]:
            parts.append(F.array_sort(F.map_entries(field.name)))
        elif "map<" not in kind and "variant" not in kind:
            parts.append(F.col(field.name))
    return F.struct(F.xxhash64(*parts).alias("a"), F.hash(*parts).alias("b"))


def add_position(
    df: DataFrame,
    order: str,
    keys: list[str] | None = None,
    into: str = "pos",
    ties: list[str] | None = None,
) -> DataFrame:
    """1-based position in ``order`` (within ``keys`` when given).

    ``order`` is any sortable column; rows of equal order go by ``ties``, then by a
    hash of the row.  One exchange: a written partition is in order, so a row's
    number in it, less the first number of its key there, plus the key's rows in the
    partitions before, is its position.
    """
    keys = keys or []
    by = [*keys, order, *(ties or []), "__row"]
    spark = df.sparkSession
    folder = new_workspace(spark, "positions")
    placed = df.withColumn("__row", _row_hash(df)).repartitionByRange(*by).sortWithinPartitions(*by)
    placed.drop("__row").withColumn("__id", F.monotonically_increasing_id()).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    part = F.shiftright("__id", 33)
    # A row per partition and key; a key has at most one for each partition.
    before = W.partitionBy(*keys).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    counted = rows.groupBy(part.alias("__part"), *keys).agg(F.count(F.lit(1)).alias("__n"), F.min("__id").alias("__first"))
    shift = F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + 1
    counted.select(F.struct("__part", *keys).alias("__of"), shift.alias("__shift")).write.parquet(f"{folder}/starts")
    starts = spark.read.parquet(f"{folder}/starts")  # its size is known: Spark broadcasts it if it is small
    return (
        rows.join(starts, F.struct(part.alias("__part"), *keys) == F.col("__of"))
        .withColumn(into, (F.col("__id") + F.col("__shift")).cast("bigint"))
        .select(*df.columns, into)
    )


def _literal(value, kind: T.DataType) -> Column:
    if value is None:
        return F.lit(None).cast(kind)
    if isinstance(kind, T.StructType):
        return F.struct(*[_literal(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return F.array(*[_literal(x, kind.elementType) for x in value]).cast(kind)
    return F.lit(value).cast(kind)


def _nth(places: DataFrame, n: int, rows: int) -> tuple:
    """(the n-th lowest place, places below it, places up to it), n at most ``rows``.

    A sample of the range that holds it gives two places around it; counting the
    rows up to each leaves a small part of the range, again and again.
    """
    kind = places.schema["p"].dataType
    p = F.col("p")
    inside, base, seed = F.lit(True), 0, 7
    while True:
        ranged = places.filter(inside)
        if rows <= _SMALL_RANGE:
            found = [r["p"] for r in ranged.orderBy("p").collect()]
            tried = [found[n - base - 1]]
        else:
            some = ranged.sample(min(1.0, 1.5 * _SMALL_RANGE / rows), seed).limit(2 * _SMALL_RANGE)
            drawn = [r["p"] for r in some.orderBy("p").collect()]
            if not drawn:
                seed += 1
                continue
            at, margin = (n - base) / rows * len(drawn), 2 * math.sqrt(len(drawn))
            tried = [drawn[min(max(int(x), 0), len(drawn) - 1)] for x in (at - margin, at + margin)]
        below = [F.count_if(p < _literal(t, kind)) for t in tried]
        upto = [F.count_if(p <= _literal(t, kind)) for t in tried]
        counts = ranged.agg(*[c.alias(f"c{i}") for i, c in enumerate([*below, *upto])]).first()
        left, seed = n - base, seed + 1
        for i, t in enumerate(tried):
            if counts[i] < left <= counts[len(tried) + i]:
                return t, base + counts[i], base + counts[len(tried) + i]
        # Not one of the tried places: below the first, between two, or above the last.
        k = sum(counts[len(tried) + i] < left for i in range(len(tried)))
        passed = counts[len(tried) + k - 1] if k else 0
        if k:
            inside = inside & (p > _literal(tried[k - 1], kind))
        if k < len(tried):
            inside = inside & (p < _literal(tried[k], kind))
        rows = (counts[k] if k < len(tried) else rows) - passed
        base += passed


def nth_place(df: DataFrame, place: Column, n: int) -> tuple | None:
    """(the n-th lowest place, rows below it, rows up to it) as a struct column has it; None with at most n rows.

    Only the places are read; they are written once and neither sorted nor exchanged.
    """
    folder = new_workspace(df.sparkSession, "places")
    df.select(place.alias("p")).write.parquet(folder)
    places = df.sparkSession.read.parquet(folder)
    rows = places.count()
    return _nth(places, n, rows) if rows > n else None


def up_to(order: str, last, kind: T.DataType) -> Column:
    """Rows up to a place in order, NULLs first; atomic orders reach the scan with it."""
    return F.col(order).isNull() if last is None else F.col(order).isNull() | (F.col(order) <= _literal(last, kind))


def first_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    """The ``n`` lowest rows by ``order``; rows of equal order go by a hash of the row.

    The n-th place is found by selection on the order alone, then one filter takes the
    rows up to it; rows are neither sorted nor exchanged.  Where more rows share the
    last place than are needed, those are selected by their hashes in the same way; of
    rows that are equal in every column as many copies are made as are needed.
    """
    if n <= 0:
        return df.filter(F.lit(False))
    place, kind = F.struct(F.col(order).alias("o")), df.schema[order].dataType
    found = nth_place(df, place, n)
    if found is None:
        return df
    last, below, upto = found
    bound = F.struct(_literal(last["o"], kind).alias("o"))
    reached = df.filter(up_to(order, last["o"], kind))
    if upto == n:
        return reached.filter(place <= bound)
    out, tied, own = reached.filter(place < bound), reached.filter(place == bound), _row_hash(df)
    last, equal_below, equal_upto = nth_place(tied, own, n - below)
    bound = F.struct(F.lit(last["a"]).cast("bigint").alias("a"), F.lit(last["b"]).alias("b"))
    if equal_upto == n - below:
        return out.unionByName(tied.filter(own <= bound))
    alike = tied.filter(own == bound).limit(1)
    copies = alike.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), n - below - equal_below))).drop("__copy")
    return out.unionByName(tied.filter(own < bound)).unionByName(copies)


def slice_rows(df: DataFrame, order: str, offset: int = 0, limit: int | None = None) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` by position; 0 or None means all.

    ``order`` is the dense 0-based source position, so a slice is a filter the
    scan can prune by.
    """
    out = df.filter(F.col(order) >= offset)
    return out.filter(F.col(order) < offset + limit) if limit else out


def filter_then_limit(df: DataFrame, order: str, predicate: Column, offset: int = 0, limit: int | None = None) -> DataFrame:
    """Offset on positions, then filter, then keep the first rows left."""
    out = df.filter(F.col(order) >= offset).filter(predicate)
    return out.orderBy(order).limit(limit) if limit else out


def order_map(base: DataFrame, key: str, order: str) -> DataFrame:
    """Key -> position of its last row in the base list."""
    return base.groupBy(key).agg(F.max(order).alias("base_ord"))


def by_reference_order(df: DataFrame, key: str, positions: DataFrame, unknown: Column, into: str = "base_ord") -> DataFrame:
    """Attach the base position; rows the base does not know get ``unknown``."""
    pos = positions.select(F.col(key).alias("__k"), F.col("base_ord").alias("__o"))
    spread = [c for c, kind in df.dtypes if not kind.startswith("map")]
    placed = left_lookup(df, pos, F.col(key), "__k", spread)
    return placed.withColumn(into, F.coalesce("__o", unknown)).drop("__o")
