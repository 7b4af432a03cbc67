"""Joins on keys of any skew, and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import stored

# Stored sides of at most so many rows and bytes of files are broadcast, larger ones shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 4 << 20
# A bit map of wanted keys takes 8 MB at most, in pieces of 4 KB.
SKETCH_BITS = 1 << 26


def fits(df: DataFrame, rows: int) -> bool:
    """Whether a stored side of so many rows may be broadcast; Spark knows the size of its files."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint where rows and bytes of a stored side allow it."""
    return F.broadcast(df) if fits(df, rows) else df


def attach(rows: DataFrame, found: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """lookup for a stored side, counted first and broadcast if it is small."""
    small = fits(found, found.count())
    return rows.join(F.broadcast(found), key, how) if small else lookup(rows, found, key, how)


def lookup(rows: DataFrame, found: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """rows with the columns of found, which has few rows per key.

    The join runs on a hash of the key, so both sides are exchanged for it even
    where found is grouped by the key already; AQE can then split a hot key.
    """
    right = found.withColumn("__at", F.xxhash64(key)).withColumnRenamed(key, "__found")
    same = (F.col("__probe") == F.col("__at")) & (F.col(key) >= F.col("__found")) & (F.col(key) <= F.col("__found"))
    return rows.withColumn("__probe", F.xxhash64(key)).join(right, same, how).drop("__probe", "__at", "__found")


def maybe_in(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """rows whose key may be in wanted, and few others: a filter before a join that would exchange all of them.

    The hashes of the wanted keys are marked in a bit map of bounded size, in pieces.
    """
    bit = F.pmod(F.xxhash64(key), F.lit(SKETCH_BITS)) + 1
    marked = wanted.select(bit.alias("__bit")).groupBy(F.bitmap_bucket_number("__bit").alias("__piece"))
    pieces = stored(marked.agg(F.bitmap_construct_agg(F.bitmap_bit_position("__bit")).alias("__bits")), "sketch")
    at = F.bitmap_bit_position("__bit")
    byte = F.conv(F.hex(F.substring("__bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    probed = rows.withColumn("__bit", bit).withColumn("__piece", F.bitmap_bucket_number("__bit"))
    found = probed.join(F.broadcast(pieces), "__piece").filter(F.getbit(byte, (at % 8).cast("int")) == 1)
    return found.select(*rows.columns)


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label): the least node of each connected component.

    Labels move to neighbours and then jump to the label of the label, so chains
    shorten by half a round; each round is written to the shared folder.
    """
    both = stored(
        edges.select(F.col(a).alias("node"), F.col(b).alias("other"))
        .union(edges.select(F.col(b), F.col(a)))
        .distinct(),
        "edges",
    )
    labels = stored(
        both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("label")), "labels"
    )
    while True:
        near = lookup(both, labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("m"))
        least = lookup(labels, near, "node").select("node", "label", F.least("label", "m").alias("next"))
        ahead = labels.select(F.col("node").alias("next"), F.col("label").alias("jump"))
        moved = stored(
            lookup(least, ahead, "next").select("node", "label", F.least("next", "jump").alias("next")), "labels"
        )
        if moved.filter("next <> label").isEmpty():
            return labels
        labels = moved.select("node", F.col("next").alias("label"))
