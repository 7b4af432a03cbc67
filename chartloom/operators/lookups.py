"""Keyed enrichment joins.

Every lookup side is reduced to one row per key first, so a join never adds
rows.  The sides carry no broadcast hint: Spark broadcasts one whose size it
knows to be under the session threshold and shuffles it beyond that.

A base key may hold a large share of the base rows.  AQE splits such a partition
only where both join inputs come straight from an exchange, and a side that was
just grouped by its key would be joined without one.  So the join runs on a
derived probe text: the side is exchanged once more after it was reduced, and
the base's hot partitions are split at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.values import or_empty
from chartloom.operators.keyed import collect_top, last_wins

_SPREAD = 4096


def probe_key(key: Column, *spread: Column) -> Column:
    """Join key of the base side; rows without one are spread over the tasks.

    A NULL key matches nothing, but all NULLs hash to one partition.  They get
    one of many values no lookup key can take.
    """
    salt = F.pmod(F.hash(*spread), F.lit(_SPREAD)).cast("string")
    return F.coalesce(_probe(F.nullif(key.cast("string"), F.lit(""))), F.concat(F.lit("-"), salt))


def _probe(key: Column) -> Column:
    return F.concat(F.lit("="), key)


def with_probe(base: DataFrame, key: Column, into: str, spread: list[str]) -> DataFrame:
    """Add a probe column.  Lookups that name the same one share its exchange."""
    return base.withColumn(into, probe_key(key, *[F.col(c) for c in spread]))


def left_lookup(base: DataFrame, side: DataFrame, key: Column | str, side_key: str, spread: list[str]) -> DataFrame:
    """Left join of a one-row-per-key side; drops the side's key.

    ``key`` is an expression, or the name of a column made by ``with_probe``.
    """
    right = side.withColumn("__rk", _probe(F.col(side_key).cast("string"))).drop(side_key)
    if isinstance(key, str):
        return base.join(right, F.col(key) == F.col("__rk"), "left").drop("__rk")
    left = with_probe(base, key, "__lk", spread)
    return left.join(right, F.col("__lk") == F.col("__rk"), "left").drop("__lk", "__rk")


def has_key(key: Column) -> Column:
    return key.cast("string") != ""


def attach_struct(
    base: DataFrame, records: DataFrame, key: str, order, value: Column, into: str, spread: list[str], probe: str | None = None
) -> DataFrame:
    """Attach ``value`` of the last record with the row's key.

    Without a match an existing column ``into`` keeps its value.
    """
    side = last_wins(
        records.filter(has_key(F.col(key)) & value.isNotNull()).select(
            F.col(key).alias("__side"), value.alias("__value"), *[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)]
        ),
        "__side",
        [f"__o{i}" for i in range(len(order))],
    ).select("__side", "__value")
    joined = left_lookup(base, side, probe or F.col(key), "__side", spread)
    new = F.coalesce("__value", into) if into in base.columns else F.col("__value")
    return joined.withColumn(into, new).drop("__value")


def other_columns(df: DataFrame, base_columns) -> Column:
    """All columns except the given ones, as one struct."""
    return F.struct(*[F.col(c) for c in df.columns if c not in set(base_columns)])


def attach_lists(base: DataFrame, side: DataFrame, key: Column | str, side_key: str, value: str, spread: list[str]) -> DataFrame:
    """Left join to a list per key, empty when there is none."""
    joined = left_lookup(base, side, key, side_key, spread)
    return joined.withColumn(value, or_empty(F.col(value), side.schema[value].dataType.simpleString()))


def list_by_two_keys(
    base: DataFrame,
    entries: DataFrame,
    keys: tuple[str, str],
    base_keys: tuple[Column | str, Column | str],
    order: list,
    n: int,
    entry: list[Column],
    into: str,
    spread: list[str],
) -> DataFrame:
    """Entries listed under two keys; the first key is probed first.

    An id with no entries falls through to the second key, then to an empty
    list.  Each side is cut to ``n`` rows per key before it is collected.  The
    second key is joined first, as it is the one earlier lookups share.
    """
    out = base
    for i in (1, 0):
        key, probe = keys[i], base_keys[i]
        side = collect_top(entries.filter(has_key(F.col(key))), key, order, n, entry, f"__list{i}")
        out = left_lookup(out, side, probe, key, spread)
    kind = side.schema["__list0"].dataType.simpleString()
    return out.withColumn(into, F.coalesce("__list0", "__list1", F.array().cast(kind))).drop("__list0", "__list1")


def attach_links(base: DataFrame, links: DataFrame, key: Column | str, spread: list[str]) -> DataFrame:
    """The row's own id and url win, a non-empty candidate list overrides."""
    joined = left_lookup(
        base,
        links.select(
            F.col("track_key").alias("__side"),
            F.col("youtube_id").alias("__id"),
            F.col("youtube_url").alias("__url"),
            F.col("youtube_candidates").alias("__cand"),
        ),
        key,
        "__side",
        spread,
    )

    def own(name, found):
        mine = F.nullif(F.col(name), F.lit("")) if name in base.columns else F.lit(None)
        return F.coalesce(mine, F.nullif(F.col(found), F.lit("")))

    kept = F.col("youtube_candidates") if "youtube_candidates" in base.columns else F.lit(None)
    return (
        joined.withColumn("youtube_id", own("youtube_id", "__id"))
        .withColumn("youtube_url", own("youtube_url", "__url"))
        .withColumn("youtube_candidates", F.when(F.size("__cand") > 0, F.col("__cand")).otherwise(kept))
        .drop("__id", "__url", "__cand")
    )


def join_renamed(base: DataFrame, side: DataFrame, key: str, side_key: str, first: list[str]) -> DataFrame:
    """Left join on differently named keys; the side's key goes, ``first`` leads."""
    joined = base.join(side, base[key] == side[side_key], "left").drop(side[side_key])
    return joined.select(*first, *[c for c in side.columns if c != side_key and c not in base.columns])


def write_back(base: DataFrame, results: DataFrame, row: str, columns: list[str], order: str) -> DataFrame:
    """Overwrite columns by row id; a NULL result overwrites too.

    Of several results for a row the last in ``order`` counts.
    """
    one = last_wins(results, row, order)
    side = one.select(F.col(row).alias("__row"), F.lit(True).alias("__hit"), *[F.col(c).alias(f"__{c}") for c in columns])
    joined = base.join(side, base[row] == side["__row"], "left")
    for c in columns:
        old = F.col(c) if c in base.columns else F.lit(None)
        joined = joined.withColumn(c, F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(old))
    return joined.drop("__row", "__hit", *[f"__{c}" for c in columns])
