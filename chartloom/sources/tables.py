"""Readers and writers for CSV, JSON and published tables."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartloom.schemas import clean_nans


def read_csv(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """CSV with a header; records may hold line breaks in quotes.

    Such files are read whole, a task per file.  Without line breaks in any value
    ``multi_line=False`` lets Spark split them.
    """
    reader = spark.read.schema(schema).option("header", True).option("multiLine", multi_line).option("escape", '"')
    return clean_nans(reader.csv(path))


def _one_record_a_line(spark: SparkSession, path: str) -> bool:
    first = spark.read.text(path).filter(F.trim("value") != "").limit(1).collect()
    line = first[0]["value"].strip() if first else "{}"
    return line.startswith("{") and line.endswith("}")


def read_json(spark: SparkSession, path: str, schema: str, lines: bool | None = None) -> DataFrame:
    """JSON Lines, which Spark splits, or one array document; told by the first line unless given."""
    if lines is None:
        lines = _one_record_a_line(spark, path)
    return clean_nans(spark.read.schema(schema).option("multiLine", not lines).json(path))


def read_records(
    spark: SparkSession, path: str, schema: str, lines: bool | None = None, multi_line: bool = True
) -> DataFrame:
    """By suffix: JSON for .json, CSV for anything else.  Missing input fails."""
    if path.lower().endswith(".json"):
        return read_json(spark, path, schema, lines)
    return read_csv(spark, path, schema, multi_line)


def _is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_optional(
    spark: SparkSession, path: str, schema: str, lines: bool | None = None, multi_line: bool = True
) -> DataFrame:
    try:
        return read_records(spark, path, schema, lines, multi_line)
    except AnalysisException as e:
        if _is_missing(e):
            return spark.createDataFrame([], schema)
        raise


def with_source_order(df: DataFrame, into: str = "ord") -> DataFrame:
    """Dense 0-based source position of each row of a file scan.

    Rows are numbered per file block in the order they are read, then the
    blocks, so no task numbers more than one block.
    """
    at = df.select(
        "*",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block_at"),
        F.monotonically_increasing_id().alias("__seq"),
    )
    within = W.partitionBy("__file", "__block_at").orderBy("__seq")
    counts = at.groupBy("__file", "__block_at").agg(F.count(F.lit(1)).alias("__n"))
    before = W.orderBy("__file", "__block_at").rowsBetween(W.unboundedPreceding, -1)  # one row per file block
    starts = counts.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    placed = at.withColumn("__i", F.row_number().over(within)).join(starts, ["__file", "__block_at"])
    return placed.withColumn(into, (F.col("__start") + F.col("__i") - 1).cast("bigint")).drop(
        "__file", "__block_at", "__seq", "__i", "__start"
    )


def write_csv(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Sharded CSV; a shard is read by one task, so its rows are bounded."""
    shards = df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    shards.option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Sharded JSON Lines, UTF-8, NULL fields kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def csv_to_json(spark: SparkSession, csv_path: str, json_path: str, schema: str) -> bool:
    """Convert; write nothing when the input has no rows."""
    rows = read_csv(spark, csv_path, schema)
    if rows.isEmpty():
        return False
    write_json(rows, json_path)
    return True


_LOG = "version bigint, folder string, append boolean"


def publish(df: DataFrame, root: str, append: bool = False) -> int:
    """Write a new version, then make it current; returns its number.

    Rows go to a folder of their own, and a one-row append to the version log names it:
    as all rows of the version, or with ``append`` as more rows of the version before.
    Readers see the old version until then; a failed write leaves the log as it was.
    Writers that take the same number come one after the other by folder name, and
    none loses appended rows.  Appending no rows changes nothing.
    """
    spark = df.sparkSession
    folder = f"part-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{folder}")
    version, _ = _current(spark, root)
    if append and spark.read.parquet(f"{root}/{folder}").isEmpty():
        return version
    entry = spark.createDataFrame([(version + 1, folder, append)], _LOG)
    entry.coalesce(1).write.mode("append").parquet(f"{root}/versions")
    return version + 1


def _current(spark: SparkSession, root: str) -> tuple[int, list[str]]:
    """Number of the current version, 0 for none, and its folders; the log has a row per publish."""
    try:
        log = spark.read.schema(_LOG).parquet(f"{root}/versions").collect()
    except AnalysisException as e:
        if _is_missing(e):
            return 0, []
        raise
    version, folders = 0, []
    for row in sorted(log):
        version, folders = row.version, [*(folders if row.append else []), row.folder]
    return version, folders


def read_published(spark: SparkSession, root: str, schema) -> DataFrame:
    """The current version; no rows when nothing was published yet."""
    _, folders = _current(spark, root)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{f}" for f in folders])


def stage(spark: SparkSession, root: str, build) -> DataFrame:
    """The stage table at ``root``: read when present, else computed and kept.

    Also the way to cut a long lineage: what was written survives the loss of
    the executors that computed it.
    """
    if not _current(spark, root)[1]:
        publish(build(), root)
    return spark.read.parquet(*[f"{root}/{f}" for f in _current(spark, root)[1]])


def with_row_count(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows, and a count of them that is there once they were written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def preview(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    return df.orderBy(order).limit(n)


