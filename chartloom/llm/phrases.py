"""Collocated phrases by vertically partitioned suffix trees.

Texts are lower-cased (A-Z only), cut into pieces at .,;:!? and line ends, and pieces
into words at spaces and tabs.  A word is known by a 64-bit hash of its language and
bytes, a phrase by the hashes of its words.

1. Words are counted.  Words below `least` cannot be in a frequent phrase, so they end
   a suffix; a bit table of fixed size tells them (a false hit costs work, not truth).
2. Vertical partitioning: prefixes of suffixes are grouped so that a group's suffixes
   fit the memory budget.  A prefix is one word; words too frequent for that are
   extended by the next word, and those pairs that still are, by the third.  Prefixes
   lie in hash cells, neighbouring cells form a group.  Only the cells and the words
   over budget are known to all tasks, both bounded by corpus size over budget.
3. Each group builds its suffix subtree, truncated at `longest` words, on its own: the
   suffixes are sorted, a node is a run of equal prefixes, and its count is the total
   of the leaves below it.
4. Counts of a phrase's parts are joined (first parts and rests are phrases or words
   themselves), which gives scores in exact decimal arithmetic.

Equal suffixes of a partition are merged before they travel, so a very frequent
phrase arrives as one row per chunk.  A task sorts one group at a time.

NULL texts are empty, NULL languages `und`.  Repeated rows count each time.  Ties are
broken down to the phrase, so ranks are unique.  Empty tables give no rows.  Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartloom.llm.common import mix, stored, whole_text
from chartloom.llm.graph import lookup

LEAST, LONGEST, FIRST, COVER = 10, 3, 2000, 50
BUDGET = 2_000_000  # suffixes per group, at most
SMALLEST = 20_000  # and no fewer than these
CHUNK = 1_000_000  # words whose equal suffixes are merged before they travel
FILTER_BITS = 1 << 26
UNKNOWN = "und"

# What ends a piece, what ends a word.
BREAKS, GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"

_KIND = np.zeros(256, np.uint8)
_KIND[list(GAPS)] = 1
_KIND[list(BREAKS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C13)  # odd, so it has an inverse
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_SPAN = 1 << 20


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


class ByteHasher:
    """Hashes of byte ranges: a polynomial from running sums, then mixed."""

    def __init__(self):
        self.up, self.down = _powers(_BASE, _SPAN), _powers(_BACK, _SPAN)

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.empty(len(start), np.uint64)
        i = 0
        while i < len(start):
            a = start[i]
            j = max(int(np.searchsorted(end, a + _SPAN, side="right")), i + 1)
            n = int(end[j - 1] - a)
            if n > len(self.up):
                self.up, self.down = _powers(_BASE, n), _powers(_BACK, n)
            with np.errstate(over="ignore"):
                sums = np.zeros(n + 1, np.uint64)
                np.cumsum(_LETTER[data[a : a + n]] * self.up[:n], out=sums[1:])
                s, e = start[i:j] - a, end[i:j] - a
                out[i:j] = (sums[e] - sums[s]) * self.down[s] + (e - s).astype(np.uint64)
            i = j
        return mix(out)


def _extended(key: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Hash of a pair, in this order."""
    with np.errstate(over="ignore"):
        return mix(mix(key + _BASE) * np.uint64(3) + more)


def tongue_hash(lang: str) -> int:
    data = np.frombuffer(lang.encode(), np.uint8)
    return int(ByteHasher()(data, np.array([0]), np.array([len(data)]))[0]) if len(data) else 0


class _Reader:
    """Words of Arrow batches of (lang, text)."""

    def __init__(self):
        self.hasher, self.tongues = ByteHasher(), {}

    def words(self, batch: pa.RecordBatch):
        """(lang of each word as an index, names of langs, key, same piece as the word before, bytes, start, end)."""
        langs = batch.column(0).dictionary_encode()
        names = langs.dictionary.to_pylist()
        if not batch.num_rows:
            none = np.empty(0, np.int64)
            return none, names, none.view(np.uint64), none.astype(bool), none.astype(np.uint8), none, none
        text = batch.column(1).cast(pa.large_binary())
        edges = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        first = int(edges[0]) if len(edges) else 0
        raw = text.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[first : int(edges[-1])] if raw is not None and len(edges) else np.empty(0, np.uint8)
        edges = edges - first
        data = _LOWER[data]
        kind = _KIND[data]
        word = kind == 0
        fresh = word.copy()
        fresh[1:] &= ~word[:-1]
        heads = edges[:-1][edges[:-1] < edges[1:]]  # a word ends with its text
        fresh[heads] = word[heads]
        last = word.copy()
        last[:-1] &= ~word[1:]
        last[heads[1:] - 1] = word[heads[1:] - 1]
        start, end = np.flatnonzero(fresh), np.flatnonzero(last) + 1
        stops = np.cumsum(kind == 2, dtype=np.int32)
        stop = stops[start] if len(start) else np.empty(0, np.int32)
        row = np.searchsorted(edges, start, side="right") - 1
        follows = np.zeros(len(start), bool)
        follows[1:] = (stop[1:] == stop[:-1]) & (row[1:] == row[:-1])
        lang = langs.indices.to_numpy(zero_copy_only=False)[row]
        for name in names:
            if name not in self.tongues:
                self.tongues[name] = tongue_hash(name)
        salt = np.array([self.tongues[n] for n in names] or [0], np.uint64)
        key = _extended(salt[lang], self.hasher(data, start, end)) if len(start) else np.empty(0, np.uint64)
        return lang, names, key, follows, data, start, end


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), whole_text(text).alias("t"))


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows of sorted columns."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, key, word, n) of all words."""

    def run(batches):
        reader = _Reader()
        for batch in batches:
            tongue, names, key, _, data, start, end = reader.words(batch)
            order = np.argsort(key, kind="stable")
            at = _runs(key[order])
            some, n = order[at], np.diff(np.append(at, len(order)))
            whole = data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([names[i] for i in tongue[some]], pa.string()),
                    pa.array(key[some].view(np.int64)),
                    pa.array([whole[a:b].decode(errors="replace") for a, b in zip(start[some].tolist(), end[some].tolist())], pa.string()),
                    pa.array(n.astype(np.int64)),
                ],
                ["lang", "key", "word", "n"],
            )

    each = _texts(docs, text, lang).mapInArrow(run, "lang string, key bigint, word string, n bigint")
    return each.groupBy("lang", "key", "word").agg(F.sum("n").alias("n"))


def bit_table(keys: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Bits set at the keys, packed; its size does not depend on the keys."""
    page = 32768
    at = F.pmod(F.col("key"), F.lit(bits))
    pages = keys.groupBy(F.floor(at / page).alias("page")).agg(F.expr(f"bitmap_construct_agg(CAST(pmod(pmod(key, {bits}), {page}) AS BIGINT))").alias("b"))
    out = np.zeros(bits // 8, np.uint8)
    for r in pages.toLocalIterator():
        first = r["page"] * (page // 8)
        room = out[first : first + page // 8]
        room[:] = np.frombuffer(r["b"], np.uint8)[: len(room)]
    return out


def has_bit(table: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = np.mod(key.view(np.int64), np.int64(len(table) * 8))
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


class _Partitioning:
    """Group of each suffix; words over budget and pairs of cells over budget are extended."""

    def __init__(self, heavy_words: np.ndarray, heavy_cells: np.ndarray, groups: np.ndarray):
        self.heavy_words, self.heavy_cells, self.groups = heavy_words, heavy_cells, groups

    def spread(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether suffixes that begin with the pair go by their third word."""
        return np.isin(a, self.heavy_words) & self.heavy_cells[_cell(_extended(a, b), len(self.groups))]

    def of(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        prefix = mix(a)
        long = np.flatnonzero(np.isin(a, self.heavy_words))
        if len(long):
            pair = _extended(a[long], b[long])
            longer = self.heavy_cells[_cell(pair, len(self.groups))]
            prefix[long] = np.where(longer, _extended(pair, c[long]), pair)
        return self.groups[_cell(prefix, len(self.groups))]


def _cell(prefix: np.ndarray, cells: int) -> np.ndarray:
    return (prefix % np.uint64(cells)).astype(np.int64)


def _cell_sums(rows: DataFrame, cells_of, cells: int, page: int = 4096) -> np.ndarray:
    """Sums per cell; cells_of gives (cells, counts or None) per batch.  Tasks send whole pages of sums."""

    def count(batches):
        sums = np.zeros(cells, np.int64)
        for cell, n in cells_of(batches):
            sums += np.bincount(cell, n, cells).astype(np.int64)
        pages = np.arange(0, cells, page)
        yield pa.RecordBatch.from_arrays([pa.array(pages), pa.array([sums[p : p + page].tobytes() for p in pages])], ["page", "sums"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums = np.frombuffer(packed, np.int64)
                total[at] = total[at] + sums if at in total else sums
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int64()), pa.array([s.tobytes() for s in total.values()], pa.binary())], ["page", "sums"]
        )

    kind = "page bigint, sums binary"
    out = np.zeros(cells, np.int64)
    for r in rows.mapInArrow(count, kind).repartition("page").mapInArrow(add, kind).toLocalIterator():
        out[r["page"] : r["page"] + page] = np.frombuffer(r["sums"], np.int64)
    return out


def grouped_cells(weights: np.ndarray, budget: int) -> np.ndarray:
    """Group of each cell: neighbours together while they fit the budget."""
    out, group, held = np.empty(len(weights), np.int32), 0, 0
    for i, w in enumerate(weights.tolist()):
        if held and held + w > budget:
            group, held = group + 1, 0
        out[i] = group
        held += w
    return out


def suffixes(key: np.ndarray, follows: np.ndarray, longest: int, frequent: np.ndarray) -> list[np.ndarray]:
    """Columns of the suffixes of two or more words that begin with frequent words; 0 past the end."""
    fine = has_bit(frequent, key)
    reach = [key]
    going = fine.copy()
    for k in range(1, longest):
        step = np.zeros(len(key), bool)
        step[: len(key) - k] = going[: len(key) - k] & follows[k:] & fine[k:]
        going = step
        nxt = np.zeros(len(key), np.uint64)
        nxt[: len(key) - k] = key[k:]
        reach.append(np.where(going, nxt, np.uint64(0)))
    keep = reach[1] != 0
    return [r[keep] for r in reach]


def _merged(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted rows, equal ones once with their summed counts."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    at = _runs(*columns)
    return [c[at] for c in columns], np.add.reduceat(n[order], at) if len(at) else n[:0]


def _chunks(batches, reader: _Reader, longest: int, frequent: np.ndarray, chunk: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Merged suffixes of about `chunk` words at a time."""
    held, size = [], 0

    def flush():
        columns = [np.concatenate(c) for c in zip(*held)]
        return _merged(columns, np.ones(len(columns[0]), np.int64))

    for batch in batches:
        _, _, key, follows, *_ = reader.words(batch)
        if len(key):
            held.append(suffixes(key, follows, longest, frequent))
            size += len(key)
        if size >= chunk:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def subtree(columns: list[np.ndarray], n: np.ndarray, least: int, spread=None) -> list[tuple[int, list[np.ndarray], np.ndarray]]:
    """(depth, path, count) of the nodes of two or more words with `least` occurrences.

    The leaves are the distinct suffixes; a node's count is the total of its leaves.
    Pairs for which `spread` holds have leaves elsewhere too and are kept at any count.
    """
    columns, n = _merged(columns, n)
    out = []
    for depth in range(2, len(columns) + 1):
        inside = columns[depth - 1] != 0
        path = [c[inside] for c in columns[:depth]]
        at = _runs(*path)
        total = np.add.reduceat(n[inside], at) if len(at) else n[:0]
        often = total >= least
        if depth == 2 and spread is not None:
            often |= spread(path[0][at], path[1][at])
        out.append((depth, [p[at][often] for p in path], total[often]))
    return out


def phrase_counts(docs: DataFrame, words: DataFrame, text: str, lang: str, least: int, budget: int, chunk: int, bits: int) -> DataFrame:
    """(a, b, c, n) of the phrases of two words (c is NULL) and three with `least` occurrences."""
    spark = docs.sparkSession
    texts = _texts(docs, text, lang)
    often = words.filter(F.col("n") >= least)
    frequent = spark.sparkContext.broadcast(bit_table(often, bits))
    total = words.agg(F.sum("n")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    budget = min(budget, max(total // (4 * tasks), SMALLEST))  # small corpora give work to all tasks
    cells = 1 << max(16, int(16 * total / budget).bit_length())
    half = max(budget // 2, 1)
    over = often.filter(F.col("n") > half).select("key").collect()  # at most total / half
    heavy_words = np.array(sorted(r["key"] for r in over), np.int64).view(np.uint64)

    def word_cells(batches):
        for batch in batches:
            yield _cell(mix(batch.column(0).to_numpy().view(np.uint64)), cells), batch.column(1).to_numpy()

    def pair_cells(batches):
        reader = _Reader()
        for batch in batches:
            _, _, key, follows, *_ = reader.words(batch)
            a, b = suffixes(key, follows, 2, frequent.value)
            of = np.isin(a, heavy_words)
            yield _cell(_extended(a[of], b[of]), cells), None

    weights = _cell_sums(often.filter(F.col("n") <= half).select("key", "n"), word_cells, cells)
    heavy_cells = np.zeros(cells, bool)
    if len(heavy_words):
        pairs = _cell_sums(texts, pair_cells, cells)
        heavy_cells = pairs > half  # at most total / half; their pairs are spread by the third words
        weights += np.where(heavy_cells, 0, pairs) + int(pairs[heavy_cells].sum()) // cells + 1
    groups = grouped_cells(weights, budget)
    route = spark.sparkContext.broadcast(_Partitioning(heavy_words, heavy_cells, groups))

    def send(batches):
        reader = _Reader()
        for columns, n in _chunks(batches, reader, LONGEST, frequent.value, chunk):
            group = route.value.of(*columns)
            order = np.argsort(group, kind="stable")  # suffixes stay sorted within a group
            group = group[order]
            at = _runs(group)
            packed = [c[order].astype("<u8") for c in columns] + [n[order].astype("<u4" if n.max(initial=0) < 1 << 32 else "<u8")]
            for i in range(0, len(at), 8):
                own = at[i : i + 9]
                ends = np.append(own, len(group)) if i + 8 >= len(at) else own
                rows = [pa.array([c[x:y].tobytes() for x, y in zip(ends[:-1], ends[1:])], pa.binary()) for c in packed]
                yield pa.RecordBatch.from_arrays([pa.array(group[ends[:-1]]), *rows], ["group", "a", "b", "c", "n"])

    def build(batches):
        held, at = [], None
        for batch in batches:
            for group, *parts in zip(*(c.to_pylist() for c in batch.columns)):
                if group != at and held:
                    yield from _nodes(held, least, route.value)
                    held = []
                at = group
                *columns, n = parts
                columns = [np.frombuffer(c, "<u8") for c in columns]
                held.append((*columns, np.frombuffer(n, "<u4" if len(n) == 4 * len(columns[0]) else "<u8").astype(np.int64)))
        if held:
            yield from _nodes(held, least, route.value)

    sent = texts.mapInArrow(send, "group int, a binary, b binary, c binary, n binary")
    dealt = sent.repartition(tasks, "group").sortWithinPartitions("group")
    return dealt.mapInArrow(build, "a bigint, b bigint, c bigint, n bigint").groupBy("a", "b", "c").agg(F.sum("n").alias("n"))


def _nodes(held: list[tuple], least: int, route: _Partitioning) -> Iterator[pa.RecordBatch]:
    """Frequent nodes of a group; pairs spread over groups come with what each group has."""
    *columns, n = (np.concatenate(c) for c in zip(*held))
    for depth, path, total in subtree(columns, n, least, route.spread):
        cols = [pa.array(p.view(np.int64)) for p in path]
        if depth == 2:
            cols.append(pa.nulls(len(total), pa.int64()))
        yield pa.RecordBatch.from_arrays([*cols, pa.array(total)], ["a", "b", "c", "n"])


def _ratio(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000000 * a * a / (l * r)); counts below 10**16, so nothing passes 38 digits."""
    wide = [c.cast("decimal(16,0)") for c in (a, l, r)]
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (wide[0] * wide[0]), wide[1] * wide[2])


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    first: int = FIRST,
    least: int = LEAST,
    cover: int = COVER,
    budget: int = BUDGET,
    chunk: int = CHUNK,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first phrases of each language.

    A phrase of two or three words counts from `least` occurrences.  Its score is the
    least, over its cuts in two, of floor(10**6 a a / (l r)).  A phrase goes where a
    longer one that holds it has `cover` percent of its occurrences.
    """
    words = stored(word_counts(docs, text, lang), "words")
    found = stored(phrase_counts(docs, words, text, lang, least, budget, chunk, bits), "phrases")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    often = stored(words.filter(F.col("n") >= least), "often")

    pair = F.struct("a", "b")
    twos = found.filter("c IS NULL").select(pair.alias("pair"), "n")
    threes = found.filter("c IS NOT NULL").select("a", "b", "c", "n")
    held = threes.select(pair.alias("pair"), "n").union(threes.select(F.struct(F.col("b").alias("a"), F.col("c").alias("b")), "n"))
    covered = held.groupBy("pair").agg(F.max("n").alias("longer"))
    kept = lookup(twos, covered, "pair", "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("n")))

    def named(rows: DataFrame, key: str, tag: str) -> DataFrame:
        side = often.select(F.col("key").alias(key), F.col("word").alias(f"w{tag}"), F.col("n").alias(f"n{tag}"), F.col("lang").alias(f"lang{tag}"))
        return lookup(rows, side if tag == "1" else side.drop(f"lang{tag}"), key)

    two = named(named(kept.select("pair.a", "pair.b", "n"), "a", "1"), "b", "2")
    two = two.select(
        F.col("lang1").alias("lang"),
        F.concat_ws(" ", "w1", "w2").alias("phrase"),
        F.col("n").alias("a"),
        F.col("n1").alias("l"),
        F.col("n2").alias("r"),
        _ratio(F.col("n"), F.col("n1"), F.col("n2")).alias("score"),
    )
    ahead, behind = twos.withColumnRenamed("n", "n12"), twos.select(F.col("pair").alias("rest"), F.col("n").alias("n23"))
    three = lookup(threes.withColumn("pair", pair), ahead, "pair")
    three = lookup(three.withColumn("rest", F.struct(F.col("b").alias("a"), F.col("c").alias("b"))), behind, "rest")
    three = named(named(named(three, "a", "1"), "b", "2"), "c", "3")
    early = F.struct(_ratio(F.col("n"), F.col("n1"), F.col("n23")).alias("score"), F.lit(1).alias("k"), F.col("n1").alias("l"), F.col("n23").alias("r"))
    late = F.struct(_ratio(F.col("n"), F.col("n12"), F.col("n3")).alias("score"), F.lit(2).alias("k"), F.col("n12").alias("l"), F.col("n3").alias("r"))
    three = three.select(
        F.col("lang1").alias("lang"), F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("n").alias("a"), F.least(early, late).alias("cut")
    )
    both = two.unionByName(three.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    ranked = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = both.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= first)
    return lookup(best, totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


SQL = f"""WITH pieces AS (
    SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
  words AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
  runs AS (
    SELECT lang, w[i:i + k - 1] AS p, count(*) AS f
    FROM words, unnest(generate_series(1, len(w))) AS u(i), unnest([1, 2, 3]) AS v(k)
    WHERE i + k - 1 <= len(w) GROUP BY lang, p),
  totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM runs WHERE len(p) = 1 GROUP BY lang),
  candidates AS (
    SELECT lang, p, f AS a, k, p[1:k] AS x, p[k + 1:] AS y FROM runs, unnest([1, 2]) AS u(k) WHERE f >= {LEAST} AND k < len(p)),
  heads AS (SELECT c.*, h.f AS l FROM candidates c JOIN runs h ON h.lang = c.lang AND h.p = c.x),
  cuts AS (
    SELECT c.lang, c.p, a, k, l, t.f AS r,
      CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * t.f) AS BIGINT) AS score
    FROM heads c JOIN runs t ON t.lang = c.lang AND t.p = c.y),
  scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
  covered AS (
    SELECT lang, q, max(f) AS f FROM (
      SELECT lang, p[1:2] AS q, f FROM runs WHERE len(p) = 3 AND f >= {LEAST}
      UNION ALL SELECT lang, p[2:3], f FROM runs WHERE len(p) = 3 AND f >= {LEAST})
    GROUP BY lang, q),
  kept AS (
    SELECT s.* FROM scored s LEFT JOIN covered c ON c.lang = s.lang AND c.q = s.p
    WHERE c.f IS NULL OR 100 * c.f < {COVER} * s.a OR len(s.p) = 3)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM (SELECT lang, array_to_string(p, ' ') AS phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, score FROM kept)
JOIN totals USING (lang)
QUALIFY rank <= {FIRST}"""
