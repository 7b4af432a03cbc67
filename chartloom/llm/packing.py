"""Packing of token ids into fixed windows by non-negative least squares.

A document is its ids and an end id.  One longer than the window gives full windows
and a rest; so every piece but the full ones has a length below the window, and the
counts per length are all the plan needs.  Lengths are taken in classes of `unit`
tokens.  All multisets of two to `depth` classes that fill the window exactly are
the shapes; how often each is used is the non-negative least squares solution of
"shapes times uses = pieces per class" (active set), rounded down.  Shapes are then
laid out with real lengths, and what is left over is packed greedily, longest first
and the largest piece that fits next, whole counts at a time, into the gaps of the
shapes first.  The plan's size depends on the window alone.

A piece finds its place by its number among the pieces of its length: its number
within its partition, plus the pieces of that length in the partitions before.  No
task meets all pieces of a length.

NULL and empty texts are the end id alone.  Repeated rows are packed each.  An empty
table has no sequences.  Extra columns are not read.
"""

from __future__ import annotations

import bisect
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.llm.chunk_ids import ChunkEncoder
from chartloom.llm.common import stored
from chartloom.llm.graph import lookup

WINDOW, UNIT, DEPTH = 2048, 8, 3
END = 1


def shapes(total: int, depth: int) -> np.ndarray:
    """Multisets of two to `depth` classes that sum to total, ascending, padded with 0 in front."""
    out: list[np.ndarray] = []

    def grow(head: np.ndarray, left: np.ndarray, parts: int) -> None:
        # head: chosen classes (rows); left: what each row still lacks; parts still to choose
        if parts == 1:
            rows = np.column_stack([head, left])
            out.append(np.pad(rows, ((0, 0), (depth - rows.shape[1], 0))))
            return
        least = head[:, -1] if head.shape[1] else np.ones(len(left), np.int64)
        many = np.maximum(left // parts - least + 1, 0)
        at = np.repeat(np.arange(len(left)), many)
        pick = least[at] + np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        grow(np.column_stack([head[at], pick]), left[at] - pick, parts - 1)

    for parts in range(2, depth + 1):
        grow(np.empty((1, 0), np.int64), np.array([total]), parts)
    return np.concatenate(out) if out else np.empty((0, depth), np.int64)


def nonnegative(columns: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises the squared error of (uses of each class) - goal, by active sets.

    A row of columns lists the classes of one shape, 0 for none; goal[0] is unused.
    """
    x = np.zeros(len(columns))
    active: list[int] = []
    rest = goal.astype(float)
    rest[0] = 0.0
    scale = max(float(goal.max()), 1.0)
    matrix = np.empty((len(goal), 0))
    for _ in range(3 * len(goal)):
        gain = rest[columns].sum(axis=1)
        gain[active] = -np.inf
        j = int(gain.argmax()) if len(gain) else 0
        if not len(gain) or gain[j] <= 1e-7 * scale:
            break
        column = np.bincount(columns[j], minlength=len(goal)).astype(float)
        column[0] = 0.0
        active.append(j)
        matrix = np.column_stack([matrix, column])
        while True:
            gram = matrix.T @ matrix
            gram[np.diag_indices_from(gram)] += 1e-9
            best = np.linalg.solve(gram, matrix.T @ np.r_[0.0, goal[1:]])
            if best.min() > 0:
                break
            now = x[active]
            down = best <= 0
            step = min(1.0, float((now[down] / np.maximum(now[down] - best[down], 1e-12)).min()))
            x[active] = now + step * (best - now)
            keep = x[active] > 1e-9
            if keep.all():  # the newest cannot enter
                keep[-1] = False
            x[np.array(active)[~keep]] = 0.0
            active, matrix = [a for a, k in zip(active, keep) if k], matrix[:, keep]
            if not active:
                best = np.empty(0)
                break
        x[active] = best
        rest = np.r_[0.0, goal[1:]] - (matrix @ best)
        rest[0] = 0.0
    return x


class _Stock:
    """Pieces left per length."""

    def __init__(self, counts: dict[int, int]):
        self.n = {length: n for length, n in counts.items() if n > 0}
        self.lengths = sorted(self.n)

    def take(self, length: int, n: int) -> None:
        self.n[length] -= n
        if not self.n[length]:
            del self.n[length]
            self.lengths.remove(length)

    def largest(self, room: int) -> int:
        i = bisect.bisect_right(self.lengths, room)
        return self.lengths[i - 1] if i else 0


def _laid_out(shape: list[int], uses: int, stock: _Stock, unit: int) -> list[tuple[list[tuple[int, int]], int]]:
    """(parts, repeats) of a shape with real lengths, the longest of each class first."""
    out = []
    while uses:
        picked: list[int] = []
        for c in shape:
            of = {length: stock.n[length] - picked.count(length) for length in stock.lengths if (length - 1) // unit + 1 == c}
            some = [length for length, n in of.items() if n > 0]
            if not some:
                return out
            picked.append(max(some))
        repeats = min(uses, *(stock.n[length] // picked.count(length) for length in picked))
        for length in picked:
            stock.take(length, repeats)
        out.append(([(length, 1) for length in picked], repeats))
        uses -= repeats
    return out


def _filled(parts: list[tuple[int, int]], repeats: int, room: int, stock: _Stock):
    """Patterns from one with room left, the largest pieces that fit added."""
    open_, done = [(parts, repeats, room)], []
    while open_:
        parts, repeats, room = open_.pop()
        length = stock.largest(room)
        if not length:
            done.append((parts, repeats))
            continue
        n = stock.n[length]
        if n >= repeats:
            k = min(room // length, n // repeats)
            stock.take(length, k * repeats)
            open_.append(([*parts, (length, k)], repeats, room - k * length))
        else:
            stock.take(length, n)
            open_.append((parts, repeats - n, room))
            open_.append(([*parts, (length, 1)], n, room - length))
    return done


def patterns(counts: dict[int, int], window: int = WINDOW, unit: int = UNIT, depth: int = DEPTH):
    """(parts, repeats) of all sequences, parts as (length, how many); every piece is in one."""
    stock, out = _Stock(counts), []
    if window in stock.n:
        out.append(([(window, 1)], stock.n[window]))
        stock.take(window, stock.n[window])
    classes = window // unit
    goal = np.zeros(classes + 1)
    for length, n in stock.n.items():
        goal[(length - 1) // unit + 1] += n
    columns = shapes(classes, depth)
    uses = np.floor(nonnegative(columns, goal) + 1e-6).astype(np.int64)
    started = []
    for j in np.argsort(-uses, kind="stable"):
        if uses[j]:
            started += _laid_out([int(c) for c in columns[j] if c], int(uses[j]), stock, unit)
    for parts, repeats in started:
        out += _filled(parts, repeats, window - sum(length * k for length, k in parts), stock)
    while stock.lengths:
        length = stock.lengths[-1]
        n = stock.n[length]
        k = min(window // length, n)
        stock.take(length, n // k * k)
        out += _filled([(length, k)], n // k, window - k * length, stock)
    return out


@dataclass(frozen=True)
class Places:
    """Where the pieces of a length lie: from piece `low` on, `many` in each sequence from `first` on, at `offset`."""

    length: np.ndarray
    low: np.ndarray
    many: np.ndarray
    first: np.ndarray
    offset: np.ndarray

    def of(self, length: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the nth piece of a length."""
        at = np.searchsorted((self.length << 48) + self.low, (length << 48) + nth, side="right") - 1
        k = nth - self.low[at]
        return self.first[at] + k // self.many[at], self.offset[at] + k % self.many[at] * length


def places(found: list) -> Places:
    used: dict[int, int] = {}
    rows, first = [], 0
    for parts, repeats in found:
        offset = 0
        for length, k in parts:
            rows.append((length, used.get(length, 0), k, first, offset))
            used[length] = used.get(length, 0) + k * repeats
            offset += length * k
        first += repeats
    rows.sort()
    return Places(*np.array(rows, np.int64).reshape(-1, 5).T.copy())


@lru_cache(maxsize=1)
def _encoder(spec: str) -> ChunkEncoder:
    return ChunkEncoder(spec)


def pieces(docs: DataFrame, spec: str, ident: str = "doc_id", text: str = "text", window: int = WINDOW, end: int = END, with_ids: bool = False) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, part, nth[, ids]) of each piece; spec is the tokenizer's JSON.

    nth numbers the pieces of a length within their partition.
    """
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches):
        encoder, part = _encoder(shared.value), TaskContext.get().partitionId()
        met = np.zeros(window + 1, np.int64)
        for batch in batches:
            flat, bounds = encoder.batch(batch.column(1))
            rows, starts, lengths, crcs, sizes, nths, kept = [], [], [], [], [], [], []
            for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                ids = np.append(flat[a:b], end).astype("<u4")
                for s in range(0, len(ids), window):
                    own = ids[s : s + window]
                    rows.append(i)
                    starts.append(s)
                    lengths.append(len(own))
                    crcs.append(zlib.crc32(own.tobytes()))
                    sizes.append(len(ids))
                    nths.append(int(met[len(own)]))
                    met[len(own)] += 1
                    if with_ids:
                        kept.append(own.astype(np.int32))
            columns = [batch.column(0).take(pa.array(rows, pa.int32()))]
            columns += [pa.array(x, pa.int64()) for x in (starts, lengths, crcs, sizes)]
            columns += [pa.array([part] * len(rows), pa.int32()), pa.array(nths, pa.int64())]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

    fields = [T.StructField("id", docs.schema[ident].dataType)]
    fields += [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")]
    fields += [T.StructField("part", T.IntegerType()), T.StructField("nth", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    names = [f.name for f in fields]
    return docs.select(F.col(ident), F.col(text).cast("string")).mapInArrow(run, T.StructType(fields))


def packed(docs: DataFrame, spec: str, ident: str = "doc_id", text: str = "text", window: int = WINDOW, unit: int = UNIT, depth: int = DEPTH, **options) -> DataFrame:
    """Pieces with sequence_id and offset; see pieces for the rest."""
    spark = docs.sparkSession
    cut = stored(pieces(docs, spec, ident, text, window, **options), "pieces")
    cells = stored(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "cells")
    counts = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    where = spark.sparkContext.broadcast(places(patterns(counts, window, unit, depth)))
    # A row per partition and length; a length has at most one for each partition.
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = cells.select(F.struct("part", "length").alias("cell"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = lookup(cut.withColumn("cell", F.struct("part", "length")), starts, "cell")
    numbered = numbered.withColumn("nth", F.col("nth") + F.col("before")).drop("cell", "before", "part")

    def run(batches):
        for batch in batches:
            length, nth = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "nth"))
            found = where.value.of(length, nth) if len(length) else (length, nth)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, found)], names)

    fields = [*numbered.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    names = [f.name for f in fields]
    return numbered.mapInArrow(run, T.StructType(fields)).drop("nth").withColumnRenamed("id", ident)


def sequences(packed_ids: DataFrame, window: int = WINDOW, fill: int = 0) -> DataFrame:
    """(sequence_id, used, ids): padded ids of each sequence of pieces packed with their ids.

    A sequence that ends at a power of two is not padded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most `window` pieces
    rows = packed_ids.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
    used = F.size("ids")
    full = F.pow(F.lit(2), F.floor(F.log2(used))).cast("int") == used
    padded = F.when(full, F.col("ids")).otherwise(F.concat("ids", F.array_repeat(F.lit(fill), F.lit(window) - used)))
    return rows.select("sequence_id", used.alias("used"), padded.alias("ids"))
