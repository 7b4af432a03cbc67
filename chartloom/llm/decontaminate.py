"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A mask lays ones and zeros over a run of words; the words under its ones are
hashed, those under zeros may differ.  Hashes of all runs of the test items are
joined to those of all documents.  Each hit fixes how item and document line up
(the diagonal); around the distinct diagonals the words are compared one by one,
and an overlap counts where a stretch of `window` item words (the whole item, if
it is shorter) agrees in at least `share` of its places.

Masks depend on the item's length, so that every allowed set of substitutions leaves
some mask untouched: from `LONG` words on the three masks below, for shorter items
all masks that leave out as many blocks of the item as words may differ.  Items of
fewer than `RUN` words, which allow no substitution and stand in ordinary prose, are
found only as whole texts, by an equality join.

All masks begin with two ones.  A bit table of fixed size holds the neighbouring words
of all items; places whose words it lacks are not hashed (a false hit costs work, not
truth).  Texts that are hit are hashed once more for the comparison, each once.

Texts are known by fingerprint, so copies are compared once and NULL ids do no
harm.  NULL and empty texts and items overlap nothing.  Items of equal text are
compared once and each gets its row.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import let, stored, whole_text, word_hashes
from chartloom.llm.graph import attach, bounded

# Six words under ones, two to four places free.
MASKS = ("11010111", "111001011", "1101100101")
WINDOW = 13
SHARE = 0.8
LONG, RUN = 12, 5
PAIR_BITS = 1 << 18


def short_masks(words: int, share: float = SHARE) -> tuple[str, ...]:
    """Masks for items of so many words: blocks of the item, as many left out as words may differ."""
    free = words - math.ceil(share * words)
    blocks = min(free + 2, words // 2)
    edges = [round(words * k / blocks) for k in range(blocks + 1)]
    out = []
    for gone in itertools.combinations(range(blocks), min(free, blocks - 1)):
        mask = "".join(("0" if k in gone else "1") * (edges[k + 1] - edges[k]) for k in range(blocks))
        out.append(mask.strip("0"))
    return tuple(dict.fromkeys(out))


def masks_by_length(masks: tuple[str, ...] = MASKS, share: float = SHARE) -> dict[int, tuple[str, ...]]:
    """Masks of items by their words; LONG stands for all longer ones."""
    return {n: short_masks(n, share) for n in range(RUN, LONG)} | {LONG: masks}


def _seed(hashes: Column, at: Column, mask: str) -> Column:
    """Hash of the words under a mask's ones, and of the mask; places past the end hash fewer words."""
    taken = [j for j, bit in enumerate(mask) if bit == "1"]
    return F.xxhash64(F.lit(mask), *(F.get(hashes, at + j) for j in taken))


def _whole(hashes: Column) -> Column:
    """Seed of a text of fewer than RUN words."""
    return F.xxhash64(F.lit("whole"), F.size(hashes), hashes)


def item_table(items: DataFrame, item_text: str = "text", item_id: str = "item_id") -> tuple[DataFrame, DataFrame]:
    """Distinct item texts with their words, and the ids that carry each text."""
    whole = whole_text(item_text)
    known = items.select(F.col(item_id).alias("item_id"), F.xxhash64(whole).alias("item"), word_hashes(whole).alias("b"))
    return (
        known.groupBy("item").agg(F.any_value("b").alias("b")).filter(F.size("b") > 0),
        known.select("item_id", "item").distinct(),
    )


def item_seeds(texts: DataFrame, masks: tuple[str, ...] = MASKS, share: float = SHARE) -> DataFrame:
    """(seed, item, at) of each run of an item that one of its masks covers wholly."""
    n, b = F.size("b"), F.col("b")
    parts = [texts.filter(n < RUN).select(_whole(b).alias("seed"), "item", F.lit(0).alias("at"))]
    for length, own in masks_by_length(masks, share).items():
        some = texts.filter(n >= LONG if length == LONG else n == length)
        for mask in own:
            starts = F.sequence(F.lit(0), n - len(mask))
            placed = some.filter(n >= len(mask)).select("item", "b", F.explode(starts).alias("at"))
            parts.append(placed.select(_seed(F.col("b"), F.col("at"), mask).alias("seed"), "item", "at"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.distinct()


def _pair(first: Column, second: Column) -> Column:
    """A number for two neighbouring words, from their hashes."""
    return F.shiftleft(first, 1).bitwiseXOR(second).bitwiseAND(F.lit(PAIR_BITS - 1))


def pair_bits(texts: DataFrame) -> Column:
    """Bits of the neighbouring words of all items, as a constant array of 64-bit numbers."""
    page = 32768
    pairs = texts.select(F.explode(F.zip_with(F.slice("b", F.lit(1), F.size("b") - 1), F.slice("b", F.lit(2), F.size("b") - 1), _pair)).alias("p"))
    pages = pairs.groupBy(F.floor(F.col("p") / page).alias("page")).agg(F.expr(f"bitmap_construct_agg(p % {page})").alias("bits"))
    out = np.zeros(PAIR_BITS // 8, np.uint8)
    for r in pages.collect():
        out[r["page"] * page // 8 : (r["page"] + 1) * page // 8] = np.frombuffer(r["bits"], np.uint8)
    return F.split(F.lit(",".join(map(str, out.view("<i8").tolist()))), ",").cast("array<bigint>")


def seeds(hashes: Column, bits: Column, masks: list[str]) -> Column:
    """Structs (at, seed) of the places whose neighbouring words an item has, mask after mask."""

    def here(first: Column, at: Column) -> Column:
        pair = _pair(first, F.get(hashes, at + 1))
        word = F.get(bits, F.shiftright(pair, 6).cast("int"))
        return F.when(F.getbit(word, pair.bitwiseAND(F.lit(63)).cast("int")) == 1, at)

    def of(places: Column) -> Column:
        if not masks:
            return F.array().cast("array<struct<at:int,seed:bigint>>")
        return F.flatten(
            F.array(*(F.transform(places, lambda at: F.struct(at.alias("at"), _seed(hashes, at, m).alias("seed"))) for m in masks))
        )

    short = F.array(F.struct(F.lit(0).alias("at"), _whole(hashes).alias("seed")))
    return F.when((F.size(hashes) > 0) & (F.size(hashes) < RUN), short).otherwise(let(F.array_compact(F.transform(hashes, here)), of))


def diagonals(docs: DataFrame, item_side: DataFrame, bits: Column, masks: list[str]) -> DataFrame:
    """Distinct (fp, item, diagonal) of all seed hits; docs holds fp and h."""
    placed = docs.select("fp", F.explode(seeds(F.col("h"), bits, masks)).alias("s")).select("fp", "s.at", "s.seed")
    hits = placed.join(item_side.withColumnRenamed("at", "item_at"), "seed")
    return hits.select("fp", "item", (F.col("at") - F.col("item_at")).alias("diagonal")).distinct()


def overlap(doc: Column, item: Column, diagonal: Column, window: int, share: float) -> Column:
    """Struct of the stretch where doc and item agree, NULL where they do not enough."""
    same = F.transform(
        item, lambda x, j: F.coalesce(F.get(doc, F.when(diagonal + j >= 0, diagonal + j)) == x, F.lit(False)).cast("int")
    )
    width = F.least(F.lit(window), F.size(item))

    def judged(e: Column) -> Column:
        agreeing = F.transform(
            F.sequence(F.lit(1), F.size(e) - width + 1),
            lambda s: F.aggregate(F.slice(e, s, width), F.lit(0), lambda total, x: total + x),
        )
        enough = F.filter(
            F.transform(agreeing, lambda n, s: F.when(n >= F.ceil(share * width), s)), lambda s: s.isNotNull()
        )

        def stretch(starts: Column) -> Column:
            first, last = F.array_min(starts), F.array_max(starts) + width
            found = F.aggregate(F.slice(e, first + 1, last - first), F.lit(0), lambda total, x: total + x)
            return F.when(
                F.size(starts) > 0,
                F.struct(
                    found.alias("same_words"),
                    (last - first).alias("words"),
                    (diagonal + first).alias("doc_start"),
                    first.alias("item_start"),
                ),
            )

        return let(enough, stretch)

    return let(same, judged)


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    masks: tuple[str, ...] = MASKS,
    window: int = WINDOW,
    share: float = SHARE,
) -> DataFrame:
    """(fp, item_id, same_words, words, doc_start, item_start): best overlap of each text and item.

    fp is fingerprint(text); positions count words from 0.
    """
    texts, ids = item_table(items)
    texts = stored(texts, "items")
    lengths = {min(r["n"], LONG) for r in texts.select(F.least(F.size("b"), F.lit(LONG)).alias("n")).distinct().collect()}
    used = [m for n, own in masks_by_length(masks, share).items() if n in lengths for m in own]
    item_side = stored(item_seeds(texts, masks, share), "item-seeds")
    whole = whole_text(text)
    hashed = docs.select(fingerprint(whole).alias("fp"), word_hashes(whole).alias("h"))
    found = diagonals(hashed, bounded(item_side, item_side.count()), pair_bits(texts), list(dict.fromkeys(used)))
    found = stored(found, "diagonals")
    # A text's comparisons are dealt over several rows, so that none holds very many.
    share_of = F.pmod(F.xxhash64("item", "diagonal"), F.lit(64))
    lined = (
        found.join(bounded(texts, texts.count()), "item")
        .groupBy("fp", share_of.alias("part"))
        .agg(F.collect_list(F.struct("item", "b", "diagonal")).alias("lines"))
    )
    lined = stored(lined, "lined")

    def checked(h: Column) -> Column:
        return F.transform(
            "lines", lambda x: F.struct(x["item"].alias("item"), overlap(h, x["b"], x["diagonal"], window, share).alias("o"))
        )

    compared = (
        docs.select(fingerprint(whole).alias("fp"), whole.alias("t"))
        .join(bounded(lined.drop("part"), lined.count()), "fp")
        .select("fp", F.explode(let(word_hashes(F.col("t")), checked)).alias("x"))
        .select("fp", "x.item", "x.o")
        .filter("o IS NOT NULL")
        .groupBy("fp", "item")
        .agg(F.max(F.struct("o.same_words", "o.words", -F.col("o.doc_start"), -F.col("o.item_start"))).alias("o"))
    )
    best = compared.select(
        "fp", "item", "o.same_words", "o.words", (-F.col("o.col3")).alias("doc_start"), (-F.col("o.col4")).alias("item_start")
    )
    return best.join(ids, "item").drop("item")


def fingerprint(text: Column) -> Column:
    return F.unhex(F.md5(text))


def clean(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """Rows whose text overlaps no item."""
    hit = stored(overlaps(docs, items, text, **options).select("fp").distinct(), "hit-texts")
    return docs.withColumn("__fp", fingerprint(whole_text(text))).join(
        bounded(hit.withColumnRenamed("fp", "__fp"), hit.count()), "__fp", "left_anti"
    ).select(*docs.columns)


def report(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """(doc_id, item_id, ...) for each document and item that overlap."""
    found = stored(overlaps(docs, items, text, **options), "overlaps")
    ids = docs.select("doc_id", fingerprint(whole_text(text)).alias("fp")).distinct()
    return attach(ids, found, "fp").drop("fp")


def _words_sql(mask: str) -> str:
    return " || ' ' || ".join(f"w[i + {j}]" for j, bit in enumerate(mask) if bit == "1")


def _doc_seed_sql() -> str:
    masks = dict.fromkeys(m for own in masks_by_length().values() for m in own)
    parts = [
        f"SELECT doc_id, i, '{m}' AS m, {_words_sql(m)} AS seed FROM doc_words, unnest(generate_series(1, len(w) - {len(m) - 1})) AS u(i)"
        for m in masks
    ]
    return " UNION ALL ".join([*parts, f"SELECT doc_id, 1, 'whole', array_to_string(w, ' ') FROM doc_words WHERE len(w) BETWEEN 1 AND {RUN - 1}"])


def _item_seed_sql() -> str:
    parts = [f"SELECT item_id, 1 AS i, 'whole' AS m, array_to_string(w, ' ') AS seed FROM item_words WHERE len(w) BETWEEN 1 AND {RUN - 1}"]
    for n, own in masks_by_length().items():
        having = f"len(w) >= {n}" if n == LONG else f"len(w) = {n}"
        parts += [
            f"SELECT item_id, i, '{m}', {_words_sql(m)} FROM item_words, unnest(generate_series(1, len(w) - {len(m) - 1})) AS u(i) WHERE {having}"
            for m in own
        ]
    return " UNION ALL ".join(parts)


def kept_words_sql(source: str, key: str) -> str:
    return (
        f"SELECT {key}, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), "
        f"lambda x: x <> '') AS w FROM {source}"
    )


OVERLAP_SQL = f"""
  item_words AS ({kept_words_sql("benchmark", "item_id")}),
  doc_seeds AS ({_doc_seed_sql()}),
  item_seeds AS ({_item_seed_sql()}),
  lined AS (
    SELECT DISTINCT doc_id, item_id, d.i - b.i AS diagonal FROM doc_seeds d JOIN item_seeds b USING (m, seed)),
  agreeing AS (
    SELECT doc_id, item_id, diagonal, least({WINDOW}, len(b.w)) AS width,
      list_transform(generate_series(1, len(b.w)),
        lambda j: CASE WHEN diagonal + j > 0 AND d.w[diagonal + j] = b.w[j] THEN 1 ELSE 0 END) AS e
    FROM lined JOIN doc_words d USING (doc_id) JOIN item_words b USING (item_id)),
  stretches AS (
    SELECT *, list_filter(generate_series(1, len(e) - width + 1),
      lambda s: list_sum(e[s:s + width - 1]) >= ceil({SHARE} * width)) AS starts FROM agreeing),
  found AS (
    SELECT doc_id, item_id, list_min(starts) - 1 AS item_start, list_max(starts) + width - list_min(starts) AS words,
      diagonal + list_min(starts) - 1 AS doc_start,
      list_sum(e[list_min(starts):list_max(starts) + width - 1]) AS same_words
    FROM stretches WHERE len(starts) > 0)"""

SQL = f"""WITH doc_words AS ({kept_words_sql("documents", "doc_id")}), {OVERLAP_SQL}
SELECT doc_id, item_id, CAST(same_words AS INT) AS same_words, CAST(words AS INT) AS words,
  CAST(doc_start AS INT) AS doc_start, CAST(item_start AS INT) AS item_start
FROM found QUALIFY row_number() OVER (PARTITION BY doc_id, item_id
  ORDER BY same_words DESC, words DESC, doc_start, item_start) = 1"""
