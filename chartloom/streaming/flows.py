"""Continuous enrichment: sources, sinks and state for Structured Streaming.

Results go to Parquet in the shared folder, never through the driver.  Changing
results are kept as one folder of changed rows per micro-batch; a batch that is
run again overwrites its own folder, and a read takes the newest row per key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.operators.keyed import last_wins
from chartloom.sources.tables import publish


def file_stream(spark: SparkSession, folder: str, name: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of the Parquet files ``name`` in ``folder``; the shape is read from them once."""
    schema = spark.read.parquet(f"{folder}/{name}").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def append_to(stream: DataFrame, root: str) -> None:
    """Drain what is there into ``root/data``; each input row lands exactly once."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{root}/data")
        .option("checkpointLocation", f"{root}/progress")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_appended(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/data")


def changes_to(
    stream: DataFrame,
    root: str,
    keys: list[str],
    order: str | None = None,
    mode: str = "append",
    on_batch: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Drain into one folder of changed rows per micro-batch.

    With ``order`` a batch is reduced to its last row per key first.
    ``on_batch`` is called with the rows kept and the batch number.
    """

    def keep(rows: DataFrame, batch: int) -> None:
        last = last_wins(rows, keys, order) if order else rows
        path = f"{root}/data/batch={batch}"
        last.write.mode("overwrite").parquet(path)
        if on_batch:
            on_batch(last.sparkSession.read.parquet(path), batch)

    query = (
        stream.writeStream.foreachBatch(keep)
        .option("checkpointLocation", f"{root}/progress")
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_changes(spark: SparkSession, root: str, keys: list[str], order: str | None = None) -> DataFrame:
    """The newest row per key over all batches: by ``order`` if given, else by batch."""
    by = [order, "batch"] if order else "batch"
    return last_wins(spark.read.parquet(f"{root}/data"), keys, by).drop("batch")


def compact(spark: SparkSession, root: str, keys: list[str], published: str, order: str | None = None) -> int:
    """Publish the current rows as one table version."""
    return publish(read_changes(spark, root, keys, order), published)


def stage_state(events: DataFrame, key: str, stage: str, stages: list[str]) -> DataFrame:
    """Stages each key has passed, and whether all are done.

    One counter per known stage instead of a collected set: the state per key
    has a fixed size however many events a key sends.
    """
    seen = [F.count_if(F.col(stage) == s).alias(f"__n{i}") for i, s in enumerate(stages)]
    counts = events.groupBy(key).agg(*seen)
    reached = F.array_compact(F.array(*[F.when(F.col(f"__n{i}") > 0, F.lit(s)) for i, s in enumerate(stages)]))
    return counts.select(key, reached.alias("stages"), (F.size(reached) == len(stages)).alias("done"))


BUCKETS = 64


def once_per_key(stream: DataFrame, root: str, key: str, buckets: int = BUCKETS) -> None:
    """Drain the first row of each key into ``root``, exactly once across restarts; NULL is one key.

    What is published is the state, laid out by a hash of the key: a batch is reduced to
    one row per key and anti-joined to the earlier keys of the buckets it falls in; no
    other bucket is read.  A batch that runs again leaves its own folder out of that and
    overwrites it.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def keep(rows: DataFrame, batch: int) -> None:
        new = rows.dropDuplicates([key]).withColumn("bucket", bucket)
        before = keys_before(rows, root, key, batch, [r["b"] for r in rows.select(bucket.alias("b")).distinct().collect()])
        if before is not None:
            new = new.join(before, new[key].eqNullSafe(before["__key"]), "left_anti")
        new.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/data/batch={batch}")

    query = (
        stream.writeStream.foreachBatch(keep)
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def keys_before(rows: DataFrame, root: str, key: str, batch: int, touched: list[int]) -> DataFrame | None:
    """Distinct keys that earlier batches published in the touched buckets; None before the first."""
    if not batch:
        return None
    shape = f"`{key}` {rows.schema[key].dataType.simpleString()}, batch int, bucket int"
    known = rows.sparkSession.read.schema(shape).parquet(f"{root}/data")
    return known.filter((F.col("batch") < batch) & F.col("bucket").isin(touched)).select(F.col(key).alias("__key")).distinct()


def read_once(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/data").drop("batch", "bucket")
