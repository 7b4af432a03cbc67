"""Upsert, replace and append by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.operators.keyed import first_wins, last_wins
from chartloom.operators.ordering import by_reference_order, first_rows


def only_new(new: DataFrame, published: DataFrame, key: str) -> DataFrame:
    return new.join(published.select(key).distinct(), key, "left_anti")


def only_known(rows: DataFrame, published: DataFrame, key: str) -> DataFrame:
    return rows.join(published.select(key).distinct(), key, "left_semi")


def with_defaults(rows: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Fill the fields a new row left unset; columns it lacks are added."""
    return rows.withColumns({c: F.coalesce(F.col(c), d) if c in rows.columns else d for c, d in defaults.items()})


def upsert(existing: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key; a new row beats an old one, a later row an earlier one."""
    both = existing.withColumn("__gen", F.lit(0)).unionByName(new.withColumn("__gen", F.lit(1)), allowMissingColumns=True)
    return last_wins(both, key, ["__gen", order]).drop("__gen")


def upsert_in_order(existing: DataFrame, new: DataFrame, key: str, order: str, positions: DataFrame, unknown: Column) -> DataFrame:
    """Upsert, with each row's base position in ``base_ord``."""
    return by_reference_order(upsert(existing, new, key, order), key, positions, unknown)


def delete_matching(rows: DataFrame, removed: DataFrame, keys: list[str]) -> DataFrame:
    """Delete rows that match on any of ``keys``.

    One anti join per key: a single join on an OR has no equi key and would
    compare all pairs.  The joins run on 256-bit hashes, each once, so that long
    texts as keys do not travel.
    """
    out = rows
    for k in keys:
        gone = removed.filter(F.col(k).isNotNull() & (F.col(k).cast("string") != ""))
        gone = gone.select(F.sha2(F.col(k).cast("string"), 256).alias("__gone")).distinct()
        out = out.withColumn("__k", F.sha2(F.col(k).cast("string"), 256))
        out = out.join(gone, out["__k"] == gone["__gone"], "left_anti").drop("__k")
    return out


def replace_matching(rows: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return delete_matching(rows, new, keys).unionByName(new, allowMissingColumns=True)


def append_new(published: DataFrame, new: DataFrame, key: str, order: str, room: int) -> DataFrame:
    """Published rows plus the first ``room`` new keys in order.

    Copies of a key merge before the anti join, so a hot key reaches it as one row.
    """
    fresh = only_new(first_wins(new, key, order), published, key)
    return published.unionByName(first_rows(fresh, order, room), allowMissingColumns=True)


def dedup_with_id(df: DataFrame, group: list[str], ident: str, order: list[str]) -> DataFrame:
    """First row per id within a group; rows without an id are all kept.

    A row without an id is its own group, told apart by ``order``, so one
    aggregate serves both kinds.
    """
    known = F.col(ident) != ""
    own = F.when(F.coalesce(~known, F.lit(True)), F.struct(*order))
    return first_wins(df.withColumn("__own", own), [*group, ident, "__own"], order).drop("__own")
