"""Quality classifier: a factorisation machine on hashed words and structure.

A text is a sparse vector: hashed words (log counts, unit length) beside structure
figures (shares of character classes, word lengths, repetition, size), standardised.
The machine adds to a linear score all pairwise interactions in low rank; the sum of
squares identity scores them in time linear in the features:
sum_f ((sum_j v_jf x_j)^2 - sum_j v_jf^2 x_j^2) / 2.

It is fitted on at most `train_rows` labelled texts, chosen by a hash of their id, on
the driver (their features only, not their texts); scores cover all texts.  NULL texts
are empty; an empty text has structure figures and no words.  Repeated rows score
alike.  Without both labels every text scores the mean label, or 0.5 with none.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.llm.common import flat_lists, held_out, whole_text, word_hashes

BUCKETS = 1 << 14
RANK = 8
TRAIN_ROWS = 3_000
THRESHOLD = 0.3
_CLASSES = ("a-z", "A-Z", "0-9", "#$%&*<>@^|~", "!", ".,;:?'\"()-", "\n", " ")


def _class_table() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for k, chars in enumerate(_CLASSES, 1):
        span = range(ord(chars[0]), ord(chars[2]) + 1) if len(chars) == 3 and chars[1] == "-" else map(ord, chars)
        for c in span:
            table[c] = k
    return table


_TABLE = _class_table()
STATS = len(_CLASSES) + 1 + 6


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column without NULLs, and the bounds of its rows."""
    _, at, data = column.buffers()
    bounds = np.frombuffer(at, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8), bounds


def describe(texts: pa.Array, values: np.ndarray, bounds: np.ndarray):
    """(doc, bucket, value, stats) of a batch: sparse words and dense figures."""
    n = len(bounds) - 1
    raw, at = _bytes_of(texts)
    kinds = _TABLE[raw]
    size = np.maximum(np.diff(at), 1)
    shares = []
    for k in range(len(_CLASSES) + 1):
        total = np.concatenate([[0], np.cumsum(kinds == k)])
        shares.append((total[at[1:]] - total[at[:-1]]) / size)
    lengths = np.diff(bounds)
    row = np.repeat(np.arange(n), lengths)
    bucket = (values.astype(np.int64).view(np.uint64) % np.uint64(BUCKETS)).astype(np.int64)
    cell, count = np.unique(row * BUCKETS + bucket, return_counts=True)
    doc, bucket = cell // BUCKETS, cell % BUCKETS
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(doc, value * value, n))
    value = value / norm[doc]
    words = np.maximum(lengths, 1)
    distinct = np.bincount(doc, minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, doc, count)
    same = np.zeros(n)
    if len(values) > 1:
        np.add.at(same, row[1:], (values[1:] == values[:-1]) & (row[1:] == row[:-1]))
    more = [np.log1p(np.diff(at)), np.log1p(lengths), np.diff(at) / words / 10, distinct / words, most / words, same / words]
    return doc, bucket, value, np.stack([*shares, *more], axis=1)


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def inputs(self, doc, bucket, value, stats):
        """Sparse rows with the standardised figures as last columns, sorted by row."""
        n = len(stats)
        dense = np.clip((stats - self.mean) / self.scale, -4, 4)
        doc = np.concatenate([doc, np.repeat(np.arange(n), stats.shape[1])])
        column = np.concatenate([bucket, np.tile(BUCKETS + np.arange(stats.shape[1]), n)])
        value = np.concatenate([value, dense.ravel()])
        order = np.argsort(doc, kind="stable")
        return doc[order], column[order], value[order]

    def raw(self, doc, column, value):
        """Score before the logistic function, and the factor sums it used."""
        start = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        vx = self.factors[column] * value[:, None]
        sums = np.add.reduceat(vx, start)
        squares = np.add.reduceat((vx * vx).sum(axis=1), start)
        first = np.add.reduceat(self.linear[column] * value, start)
        return self.bias + first + 0.5 * ((sums * sums).sum(axis=1) - squares), sums, start

    def score(self, *described) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(*self.inputs(*described))[0], -30, 30)))


def train(described, labels: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.05, decay: float = 1e-4) -> Machine:
    """Adaptive gradient steps on the logistic loss, in a fixed order."""
    doc, bucket, value, stats = described
    rng = np.random.default_rng(17)
    width = BUCKETS + stats.shape[1]
    m = Machine(0.0, np.zeros(width), rng.normal(0, 0.02, (width, RANK)), stats.mean(axis=0), stats.std(axis=0) + 1e-6)
    m.bias = float(np.log((labels.mean() + 1e-3) / (1 - labels.mean() + 1e-3)))
    doc, column, value = m.inputs(doc, bucket, value, stats)
    bounds = np.searchsorted(doc, np.arange(len(labels) + 1))
    seen, seen_v, seen_b = np.full(width, 1e-6), np.full((width, RANK), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for i in range(0, len(order), batch):
            rows = np.sort(order[i : i + batch])
            take = np.concatenate([np.arange(bounds[r], bounds[r + 1]) for r in rows])
            d = np.searchsorted(rows, doc[take])
            c, x = column[take], value[take]
            raw, sums, _ = m.raw(d, c, x)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[rows]) / len(rows)
            gx = error[d] * x
            used, back = np.unique(c, return_inverse=True)
            g = np.bincount(back, gx, len(used)) + decay * m.linear[used]
            gv = np.zeros((len(used), RANK))
            np.add.at(gv, back, gx[:, None] * (sums[d] - m.factors[c] * x[:, None]))
            gv += decay * m.factors[used]
            seen[used] += g * g
            seen_v[used] += gv * gv
            seen_b += error.sum() ** 2
            m.linear[used] -= rate * g / np.sqrt(seen[used])
            m.factors[used] -= rate * gv / np.sqrt(seen_v[used])
            m.bias -= rate * error.sum() / np.sqrt(seen_b)
    return m


def fit(labelled: DataFrame, text: str = "text", label: str = "label", **options) -> Machine | float:
    """A machine for the given rows, or their mean label if they have one label only."""

    def run(batches):
        for b in batches:
            doc, bucket, value, stats = describe(b.column(0), *flat_lists(b.column(1)))
            at = np.searchsorted(doc, np.arange(b.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array(at), pa.array(bucket)),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(value)),
                    pa.array(list(stats), pa.list_(pa.float64())),
                    b.column(2),
                ],
                ["bucket", "value", "stats", "label"],
            )

    whole = labelled.select(whole_text(text).alias("t"), word_hashes(text).alias("h"), F.col(label).cast("double").alias("label"))
    got = whole.mapInArrow(run, "bucket array<bigint>, value array<double>, stats array<double>, label double").toArrow()
    labels = got.column("label").to_numpy()
    if not len(labels) or labels.min() == labels.max():
        return float(labels.mean()) if len(labels) else 0.5
    buckets, bounds = flat_lists(got.column("bucket"))
    values, _ = flat_lists(got.column("value"))
    stats, _ = flat_lists(got.column("stats"))
    doc = np.repeat(np.arange(len(labels)), np.diff(bounds))
    return train((doc, buckets, values, stats.reshape(len(labels), -1)), labels, **options)


def scored(docs: DataFrame, machine: Machine | float, text: str = "text") -> DataFrame:
    """docs with a score from 0 to 1; a column of that name is replaced."""
    docs = docs.drop("score")
    if isinstance(machine, float):
        return docs.withColumn("score", F.lit(machine))
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    extra = docs.withColumns({"__t": whole_text(text), "__h": word_hashes(text)})
    names = docs.columns

    def run(batches):
        for b in batches:
            if b.num_rows:
                score = shared.value.score(*describe(b.column(len(names)), *flat_lists(b.column(len(names) + 1))))
                yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(score)], [*names, "score"])

    return extra.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """Texts and labels to learn from: outside the held-out fold, the first rows by a hash of the id."""
    chosen = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .select("doc_id", F.col(label).alias("label"))
        .dropDuplicates(["doc_id"])
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), F.xxhash64("text")).limit(rows)
