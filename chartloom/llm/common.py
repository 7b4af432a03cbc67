"""What the corpus operators share: tables, words as hashes, stored steps."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.session import new_workspace, tune

# White space between words, as a class for Java regular expressions.
SPACE = r"[\x20\x09-\x0D]"
# Documents are wide rows; with two Python workers in 3 GB a batch stays small.
_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def corpus_settings(spark: SparkSession) -> SparkSession:
    tune(spark)
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return corpus_settings(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back, which cuts its lineage."""
    folder = new_workspace(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def whole_text(c: str | F.Column = "text") -> F.Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def words_of(c: str | F.Column = "text") -> F.Column:
    """Words of a text in order; a NULL text has none."""
    return F.array_remove(F.split(whole_text(c), SPACE + "+"), "")


def word_hashes(c: str | F.Column = "text") -> F.Column:
    """64-bit hashes of the words in order."""
    return F.transform(words_of(c), lambda w: F.xxhash64(w))


def let(value: F.Column, body: Callable[[F.Column], F.Column]) -> F.Column:
    """body(value) with value computed once, inside one expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def held_out(doc_id: str | F.Column = "doc_id", folds: int = 5) -> F.Column:
    """Rows kept out of training: crc32 of the id as text, remainder 0."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % folds == 0, F.lit(False))


def flat_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the bounds of its rows; NULL is an empty list."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null([])
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate(
        [[0], np.cumsum(np.asarray(pa.compute.list_value_length(column), np.int64))]
    )


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix), on unsigned integers."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def shingles(values: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words, and the start of each in `values`."""
    n = len(values)
    if n < size:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    words = values.astype(np.int64).view(np.uint64)
    out = np.zeros(n - size + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[k : n - size + 1 + k])
    left = np.repeat(bounds[1:], np.diff(bounds))[: len(out)] - np.arange(len(out))
    start = np.flatnonzero(left >= size)
    return out[start], start
