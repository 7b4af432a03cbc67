"""Near-duplicates of shingle multisets by BagMinHash.

A text is the multiset of its five-word shingles.  The weight axis of a shingle
is cut into dyadic intervals, [0, 1), [1, 2), [2, 4), [4, 8) and so on; each has
a Poisson process of its own whose rate is its length.  At each point the interval
is halved: a coin gives the point to one half, the other half waits anew from
there, and halves above the weight are dropped, down to intervals of one unit.
The first interval that holds a point and lies wholly below the weight tells it to
one of the registers, which keeps the earliest time.  Two texts agree in a register
with a probability equal to their weighted Jaccard similarity.
Only points up to a horizon are drawn, which is doubled for the texts it leaves
with an empty register.

Registers are cut into bands.  Texts of a bucket are compared with its leader, and
then with each other where that may still join two classes; see links.  Comparisons
are exact on the multisets.  Links give components; equal texts are one node.

NULL texts are empty; texts without words are copies of each other.  A text of
fewer than five words is one shingle.  Repeated rows fall into one class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import flat_lists, lists, mix, shingles, stored, whole_text, word_hashes
from chartloom.llm.graph import bounded, components, lookup, maybe_in

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
# Texts whose points are drawn together; more of them take more memory.
DRAWN = 128
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _wait(h: np.ndarray, rate: np.ndarray) -> np.ndarray:
    return -np.log(_uniform(h)) / rate


def _child(seed: np.ndarray, which: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(seed + np.uint64(which) * _STEP)


def _first_points(items: np.ndarray, weights: np.ndarray):
    """(row, seed, low, high, time) of the dyadic intervals that begin below each weight."""
    out = []
    rows, block = np.arange(len(items)), 0
    while len(rows):
        low, high = (0, 1) if block == 0 else (1 << (block - 1), 1 << block)
        seed = _child(items[rows], 1000 + block)
        time = _wait(_child(seed, 5), float(high - low))
        out.append((rows, seed, np.full(len(rows), low), np.full(len(rows), high), time))
        rows = rows[weights[rows] > high]
        block += 1
    return [np.concatenate(x) for x in zip(*out)] if out else [rows, items, rows, rows, np.empty(0)]


def _step(state, weights):
    """Next processes of the given ones, each past its present point.

    A unit interval waits for its next point.  A longer one is halved: the coin's
    half holds the point (told already if the interval was told), the other half
    waits anew.  Halves above the weight go.
    """
    row, seed, low, high, time, told = state
    unit = high - low == 1
    after = _child(seed[unit], 6)
    out = [(row[unit], after, low[unit], high[unit], time[unit] + _wait(_child(after, 5), 1.0), np.zeros(unit.sum(), bool))]
    if not unit.all():
        row, seed, low, high, time, told = (x[~unit] for x in state)
        middle = (low + high) // 2
        coin = (_child(seed, 4) & np.uint64(1)).astype(bool)
        for which, lo, hi in ((2, low, middle), (3, middle, high)):
            s = _child(seed, which)
            holds = coin == (which == 2)
            t = np.where(holds, time, time + _wait(_child(s, 5), (hi - lo).astype(float)))
            go = lo < weights[row]
            out.append((row[go], s[go], lo[go], hi[go], t[go], (told & holds)[go]))
    return [np.concatenate(x) for x in zip(*out)]


def signatures(items: np.ndarray, weights: np.ndarray, doc: np.ndarray, docs: int, registers: int) -> np.ndarray:
    """Earliest time in each register, a row per document; infinite without items."""
    out = np.full(docs * registers, np.inf)
    total = np.bincount(doc, weights, docs)
    horizon = np.where(total > 0, registers * (np.log(registers) + 2) / np.maximum(total, 1), 0.0)
    state = _first_points(items, weights)
    state.append(np.zeros(len(state[0]), bool))
    while len(state[0]):
        late = []
        while len(state[0]):
            due = state[4] <= horizon[doc[state[0]]]
            late.append([x[~due] for x in state])
            row, seed, low, high, time, told = state = [x[due] for x in state]
            whole = high <= weights[row]
            new = whole & ~told
            register = mix(time[new].view(np.uint64) ^ items[row[new]]) % np.uint64(registers)
            np.minimum.at(out, doc[row[new]] * registers + register.astype(np.int64), time[new])
            state[5] = told | whole
            state = _step(state, weights)
        short = out.reshape(docs, registers).max(axis=1) > horizon
        horizon = np.where(short, horizon * 2, horizon)
        state = [np.concatenate(x) for x in zip(*late)]
        state = [x[short[doc[state[0]]]] for x in state]
    return out.reshape(docs, registers)


def bag(values: np.ndarray, bounds: np.ndarray, size: int = SHINGLE):
    """(items, weights, doc): distinct shingles of each document and their counts."""
    found, start = shingles(values, bounds, size)
    doc = np.searchsorted(bounds, start, side="right") - 1
    lengths = np.diff(bounds)
    short = np.flatnonzero((lengths > 0) & (lengths < size))
    if len(short):
        h = np.zeros(len(short), np.uint64)
        words = values.astype(np.int64).view(np.uint64)
        for k in range(size - 1):
            has = lengths[short] > k
            h[has] = mix(h[has] * _STEP + words[bounds[short][has] + k])
        found, doc = np.concatenate([found, h]), np.concatenate([doc, short])
    order = np.lexsort((found, doc))
    found, doc = found[order], doc[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return found[at], np.diff(np.append(at, len(found))), doc[at]


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    bits = signature.view(np.uint64).reshape(len(signature), bands, rows)
    out = np.broadcast_to(np.arange(bands, dtype=np.uint64), bits.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for k in range(rows):
            out = mix(out * _STEP + bits[:, :, k])
    return out.view(np.int64)


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two multisets, given as sorted arrays with repetition."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    items, ca = np.unique(a, return_counts=True)
    others, cb = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(items, others, assume_unique=True, return_indices=True)
    shared = int(np.minimum(ca[i], cb[j]).sum())
    return shared / (len(a) + len(b) - shared)


def fingerprint(text="text"):
    """Hash of the text; all texts without words have that of the empty text."""
    whole = whole_text(text)
    return F.unhex(F.md5(F.when(whole.rlike(r"[^\x20\x09-\x0D]"), whole).otherwise("")))


def _hashed(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(fingerprint(text).alias("fp"), word_hashes(text).alias("h"))


def banded(docs: DataFrame, text: str = "text", size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(fp, keys, n): the band keys of each distinct text that has words, and its number of shingles."""

    def run(batches):
        for batch in (b.slice(at, DRAWN) for b in batches for at in range(0, b.num_rows, DRAWN)):
            values, bounds = flat_lists(batch.column(1))
            items, weights, doc = bag(values, bounds, size)
            keys = band_keys(signatures(items, weights, doc, batch.num_rows, bands * rows), bands, rows)
            full = np.flatnonzero(np.diff(bounds) > 0)
            count = np.bincount(doc, weights, batch.num_rows)[full].astype(np.int64)
            packed = lists(keys[full].ravel(), np.arange(len(full) + 1) * bands, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(full)), packed, pa.array(count)], ["fp", "keys", "n"])

    signed = _hashed(docs, text).mapInArrow(run, "fp binary, keys array<bigint>, n bigint")
    return signed.groupBy("fp").agg(F.first("keys").alias("keys"), F.first("n").alias("n"))


def bags(docs: DataFrame, wanted: DataFrame, text: str = "text", size: int = SHINGLE) -> DataFrame:
    """(fp, items) of the wanted texts, and few others: all shingles sorted, as packed 64-bit integers."""

    def run(batches):
        for batch in batches:
            values, bounds = flat_lists(batch.column(1))
            items, weights, doc = bag(values, bounds, size)
            at = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            packed = [np.repeat(items[a:b], weights[a:b]).tobytes() for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["fp", "items"])

    texts = docs.select(fingerprint(text).alias("fp"), whole_text(text).alias("t"))
    chosen = maybe_in(texts, wanted, "fp").select("fp", word_hashes("t").alias("h"))
    return chosen.mapInArrow(run, "fp binary, items binary").groupBy("fp").agg(F.first("items").alias("items"))


def compared(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """(fp, leader, similarity) of the pairs, exact on the multisets."""

    def run(batches):
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            found = [
                weighted_jaccard(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)) for x, y in zip(a, b)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.float64())], ["fp", "leader", "similarity"]
            )

    own = lookup(pairs, known, "fp")
    both = lookup(own, known.select(F.col("fp").alias("leader"), F.col("items").alias("others")), "leader")
    return both.select("fp", "leader", "items", "others").mapInArrow(run, "fp binary, leader binary, similarity double")


def candidates(bags: DataFrame, similarity: float) -> DataFrame:
    """(fp, leader): the pairs of texts of different labels that may be similar, by their rarest shingles.

    `bags` has (fp, label, items).  Every text orders its shingles alike, those that fewer
    texts have first.  Texts of n and m shingles that are similar share s / (1 + s) *
    (n + m) of them, so that many must be left in both from the first one they share.
    Such a meeting is looked for at the first shingles of each text only.  Texts of the
    label that is most frequent at a shingle do not meet each other there.
    """
    slack = 1e-9
    rows = bags.select(F.xxhash64("fp").alias("id"), "items")

    def run(batches):
        for batch in batches:
            found = [np.unique(np.frombuffer(x.as_py(), np.int64), return_counts=True) for x in batch.column(1)]
            ids = np.repeat(batch.column(0).to_numpy(), [len(x) for x, _ in found])
            items, w = (np.concatenate([x[k] for x in found] or [ids]) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(items), pa.array(w.astype(np.int32))], ["id", "item", "w"])

    each = rows.mapInArrow(run, "id bigint, item bigint, w int")
    often = each.groupBy("item").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    shared = lookup(each, often, "item").groupBy("id").agg(F.collect_list(F.struct("texts", "item", "w")).alias("shared"))
    owners = bags.select(F.xxhash64("fp").alias("id"), "fp", "label", (F.octet_length("items") / 8).cast("int").alias("n"))

    def first(batches):
        for batch in batches:
            out = []
            for i, (n, shared) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3))):
                texts, item, w = (shared.values.field(k).to_numpy() for k in range(3))
                order = np.lexsort((item, texts))
                # Shingles that no other text has come before all others.
                left = np.cumsum(w[order][::-1])[::-1]
                keep = left >= similarity * n - slack
                out.append((np.full(keep.sum(), i), item[order][keep], left[keep].astype(np.int32)))
            row, item, left = (np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 3
            own = [batch.column(k).take(pa.array(row, pa.int64())) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(item, pa.int64()), pa.array(left, pa.int32())], ["fp", "label", "n", "item", "left"])

    placed = lookup(shared, owners, "id").select("fp", "label", "n", "shared")
    placed = stored(placed.mapInArrow(first, "fp binary, label binary, n int, item bigint, left int"), "prefixes")
    counted = placed.groupBy("item", "label").agg(F.count(F.lit(1)).alias("texts"))
    most = counted.groupBy("item").agg(F.max(F.struct("texts", "label")).alias("most"), F.count(F.lit(1)).alias("labels"))
    most = most.filter("labels > 1").select("item", F.col("most.label").alias("most"))
    met = stored(lookup(placed, most, "item").withColumn("most", F.col("most") == F.col("label")), "prefixes")
    other = met.select(*(F.col(c).alias(f"o_{c}") for c in met.columns))
    may = (
        (F.col("item") == F.col("o_item")) & (F.col("o_most") | (F.col("fp") < F.col("o_fp"))) & (F.col("label") != F.col("o_label"))
        & (F.least("left", "o_left") >= similarity / (1 + similarity) * (F.col("n") + F.col("o_n")) - slack)
    )
    pairs = met.filter("NOT most").join(other, may)
    return pairs.select(F.least("fp", "o_fp").alias("fp"), F.greatest("fp", "o_fp").alias("leader")).distinct()


def links(
    docs: DataFrame,
    text: str = "text",
    size: int = SHINGLE,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    leaders_a_round: int = 8,
) -> DataFrame:
    """(fp, leader, similarity) of texts found similar; fp is fingerprint(text).

    The leader of a bucket, the text that shares most buckets with others, meets all of
    it.  A text gathers the leaders of its buckets, so a pair that many buckets give
    comes once.  Then two texts of a bucket are compared unless they are in one class
    already or cannot be similar; see between.  So similar texts that share a bucket are
    in one component, whoever led it.  `leaders_a_round` is accepted and has no effect:
    one round is all.
    """
    signed = stored(banded(docs, text, size, bands, rows), "bands")
    placed = signed.select("fp", "n", F.explode("keys").alias("key"))
    shared = stored(placed.groupBy("key").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1"), "buckets")
    met = lookup(maybe_in(placed, shared, "key"), shared, "key")
    met = met.groupBy("fp", "n").agg(F.collect_list("key").alias("keys"), (-F.sum("texts")).alias("rank"))
    texts = stored(met, "texts")
    known = stored(bags(docs, texts.select("fp"), text, size), "bags")
    placed = texts.select("fp", "n", "rank", F.explode("keys").alias("key"))
    led = stored(placed.groupBy("key").agg(F.min(F.struct("rank", "fp", "n")).alias("w")).select("key", F.col("w.fp").alias("leader"), F.col("w.n").alias("m")), "leaders")
    shorter, longer = F.least("n", "m"), F.greatest("n", "m")
    pairs = lookup(placed, led, "key").filter((F.col("fp") != F.col("leader")) & (shorter >= similarity * longer)).select("fp", "leader")
    found = stored(compared(pairs.distinct(), known).filter(F.col("similarity") >= similarity), "links")
    return found.union(between(texts, led.select("key", "leader"), found, known, similarity))


def between(texts: DataFrame, led: DataFrame, found: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """(fp, leader, similarity) of similar texts whose classes differ, of buckets where such texts meet that did not lead them."""
    labels = components(found, "fp", "leader").select(F.col("node").alias("fp"), "label")
    placed = texts.select("fp", F.explode("keys").alias("key"))
    # A leader has met all of its bucket.
    rest = lookup(placed, led, "key").filter("fp <> leader").drop("leader")
    rest = stored(lookup(rest, labels, "fp", "left").withColumn("label", F.coalesce("label", "fp")), "rest")
    mixed = rest.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a <> b").select("key")
    open_ = stored(lookup(rest, mixed, "key").select("fp", "label").distinct(), "mixed")
    own = stored(lookup(maybe_in(known, open_, "fp"), open_, "fp"), "open")
    pairs = stored(candidates(own, similarity), "pairs")
    return stored(compared(pairs, own.select("fp", "items")).filter(F.col("similarity") >= similarity), "links")


def classes(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """(doc_id, fp, class): each row of docs with the label of its class."""
    found = links(docs, text, **options)
    labels = components(found, "fp", "leader").select(F.col("node").alias("fp"), "label")
    rows = docs.select("doc_id", fingerprint(text).alias("fp"))
    return stored(
        lookup(rows, labels, "fp", "left").select("doc_id", "fp", F.coalesce("label", "fp").alias("class")), "classes"
    )


def class_ids(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """(doc_id, class_id): the least doc_id of the near-duplicates of each row."""
    placed = classes(docs, text, **options)
    least = placed.groupBy("class").agg(F.min("doc_id").alias("class_id"))
    return lookup(placed, least, "class").select("doc_id", "class_id")


def keep_one(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """One row of each class: the least doc_id, NULL ids last; of equal rows any one."""
    placed = classes(docs, text, **options)
    alike = placed.groupBy("class", "doc_id", "fp").agg(F.count(F.lit(1)).alias("n"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")
    first = alike.groupBy("class").agg(F.min(rank).alias("w"))
    judged = lookup(alike, first, "class").select(
        F.col("doc_id").alias("__id"), F.col("fp").alias("__fp"), "n", (F.col("w") == rank).alias("won")
    )
    out = stored(judged.filter("NOT won OR n > 1"), "judged")
    lost, many = out.filter("NOT won"), out.filter("won")
    own = docs.withColumn("__own", fingerprint(text))
    same = (F.col("__own") == F.col("__fp")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    kept = own.join(bounded(lost, lost.count()), same, "left_anti")
    n = many.count()
    if not n:
        return kept.select(*docs.columns)
    once = kept.join(bounded(many, n), same, "left_anti")
    more = kept.join(bounded(many, n), same, "left_semi").dropDuplicates(["doc_id", "__own"])
    return once.union(more).select(*docs.columns)
