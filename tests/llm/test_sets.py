"""Operators on the corpus as a whole against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chartloom.llm import chunk_ids, merkle, packing, phrases
from chartloom.llm.q_sets import tokenizer_file


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def told(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def levels_of(nodes, fanout):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [h("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
        out.append(nodes)
    return out


def steps_of(levels, at, fanout):
    """(siblings before, siblings after) of a node on each level but the last."""
    out = []
    for nodes in levels[:-1]:
        first = at - at % fanout
        out.append((nodes[first:at], nodes[at + 1 : first + fanout]))
        at //= fanout
    return out


def manifest_of(rows, fanout=16):
    leaf = {i: h("".join(map(told, r))) for i, r in enumerate(rows)}
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[r[1]].append(i)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaf[i]))
    trees = {g: levels_of([leaf[i] for i in groups[g]], fanout) for g in names}
    top = levels_of([trees[g][-1][0] for g in names], fanout)
    out = []
    for t, g in enumerate(names):
        for at, i in enumerate(groups[g]):
            steps = steps_of(trees[g], at, fanout) + steps_of(top, t, fanout)
            doc_id, source, lang, n, text = rows[i]
            tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
            node = h("".join(map(told, (doc_id, source, lang, n, lowered(text) if tampered else text))))
            for left, right in steps:
                node = h("".join(left) + node + "".join(right))
            proof = h("".join("".join(a) + "".join(b) for a, b in steps))
            out.append((doc_id, leaf[i], trees[g][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g string, n long, node string, pos long, path string"


@pytest.mark.parametrize("sources", [3, 40])
def test_manifest_against_brute_force(spark, sources):
    rng = random.Random(sources)
    names = [None, "", *(f"s{i}" for i in range(sources))][: sources + 2]
    texts = [None, "", "Ab c", "lower", "É Ü", "x" * 3000]
    rows = []
    for i in range(700):
        source = names[-1] if i % 3 == 0 else rng.choice(names)
        rows.append((rng.choice([i, i, i, 5, None]), source, rng.choice([None, "en"]), rng.choice([None, 4]), rng.choice(texts) if i % 7 else f"T{i}"))
    rows += rows[:20]
    df = spark.createDataFrame([(*r, "a", 1, "b", 2, "c") for r in rows], SCHEMA).repartition(5)
    got = sorted((tuple(r) for r in merkle.manifest(df).collect()), key=str)
    assert got == manifest_of(rows)
    assert {False, True} == {r[-1] for r in got}


def test_manifest_of_few_rows(spark):
    one = [(1, None, None, None, None)]
    for rows in ([], one, [*one, (2, "a", "b", 3, "Text")], [(i, "s", None, None, "A") for i in range(17)]):
        df = spark.createDataFrame([(*r, "a", 1, "b", 2, "c") for r in rows], SCHEMA)
        assert sorted((tuple(r) for r in merkle.manifest(df).collect()), key=str) == manifest_of(rows)


def checked(rows, texts, window):
    """Pieces cover every document once and sequences hold them without gaps; the padding."""
    tokenizer = Tokenizer.from_file(tokenizer_file())
    ids = [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for t in texts]
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(own.tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    for i, own in enumerate(ids):
        cuts = sorted((r.start, r.length) for r in by_doc[i])
        assert [s for s, _ in cuts] == [0, *np.cumsum([n for _, n in cuts])[:-1]] and sum(n for _, n in cuts) == len(own)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    padding = 0
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in parts])
        assert [r.offset for r in parts] == [0, *ends[:-1]] and ends[-1] <= window
        padding += window - ends[-1] if ends[-1] & (ends[-1] - 1) else 0
    return padding / sum(map(len, ids))


def test_packing_holds_every_token_once(make):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["alpha", "be", "\u00e9t\u00e9", "\n", "<|endoftext|>", "x1", "..."], k=rng.randint(0, 700))) for _ in range(300)]
    texts += [None, "", " ", "word " * 9000, *["same text"] * 300]
    spec = open(tokenizer_file()).read()
    docs = make(texts)
    assert checked(packing.packed(docs, spec).collect(), texts, 2048) < 0.03
    small = packing.packed(docs, spec, window=64, unit=4, with_ids=True)
    checked(small.collect(), texts, 64)
    tokens = sum(r.length for r in small.collect())
    whole = packing.sequences(small, 64, fill=-1).collect()
    assert all(len(r.ids) == 64 or len(r.ids) & (len(r.ids) - 1) == 0 for r in whole)
    assert sum(x >= 0 for r in whole for x in r.ids) == tokens


@pytest.mark.parametrize("kept", [1_000_000, 40])
def test_chunk_ids_equal_the_library(kept):
    """Also with white space beyond ASCII, contractions, special tokens, and a table that is full."""
    rng = random.Random(kept)
    parts = [" ", "  ", "\n", "\t", "\u00a0", "\u2003", "\u3000", "\u1680", "\x85", "\x1c", "a", "Word", "word.", "don't", "'s", "\u00e9t\u00e9", ",", "...", "!?",
             "12", "<|endoftext|>", "\u4e2d\u6587", "\U0001f600", "\u2019", "\u201c", "x" * 40, "\u0416", "_", "-", "\r\n"]
    tokenizer, encoder = Tokenizer.from_file(tokenizer_file()), chunk_ids.ChunkEncoder(open(tokenizer_file()).read(), kept)
    for _ in range(30):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(40)] + [None, ""]
        ids, bounds = encoder.batch(pa.array(texts)[1:])
        want = tokenizer.encode_batch([t or "" for t in texts[1:]], add_special_tokens=False)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [w.ids for w in want]
    assert len(encoder.batch(pa.array([], pa.string()))[0]) == 0


def test_packing_an_empty_table(make):
    assert packing.packed(make(["a"]).filter("false"), open(tokenizer_file()).read()).count() == 0


def test_least_squares_meets_the_conditions_of_a_minimum():
    rng = np.random.default_rng(3)
    columns = packing.shapes(24, 3)
    assert len(columns) == len({tuple(c) for c in columns.tolist()}) and set(columns.sum(axis=1)) == {24}
    assert len(columns) == sum(1 for a in range(0, 25) for b in range(max(a, 1), 25) if a + b <= 24 and 24 - a - b >= b)
    for _ in range(5):
        goal = np.r_[0, rng.integers(0, 1000, 24)].astype(float)
        x = packing.nonnegative(columns, goal)
        use = np.zeros((len(columns), 25))
        for k in range(3):
            np.add.at(use, (np.arange(len(columns)), columns[:, k]), 1)
        use[:, 0] = 0
        slope = use @ (use.T @ x - goal)
        assert x.min() >= 0 and slope.min() > -1e-2 and abs(slope * x).max() < 10


@pytest.mark.parametrize("window, unit", [(2048, 8), (64, 4), (16, 16)])
def test_patterns_hold_every_piece(window, unit):
    rng = random.Random(window)
    counts = {length: rng.randint(1, 400) for length in range(1, window + 1) if rng.random() < 0.6}
    held = defaultdict(int)
    for parts, repeats in packing.patterns(counts, window, unit):
        assert sum(length * k for length, k in parts) <= window
        for length, k in parts:
            held[length] += k * repeats
    assert dict(held) == counts


UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def collocations_of(rows, least, first):
    f = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            f.update(("und" if lang is None else lang, tuple(w[i : i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    totals, found = Counter(), defaultdict(list)
    for (lang, p), n in f.items():
        totals[lang] += n if len(p) == 1 else 0
    longer = [(lang, p, n) for (lang, p), n in f.items() if len(p) == 3 and n >= least]
    for (lang, p), a in f.items():
        if len(p) == 1 or a < least:
            continue
        if len(p) == 2 and any(x == lang and p in (q[:2], q[1:]) and 100 * n >= 50 * a for x, q, n in longer):
            continue
        score, _, l, r = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))  # noqa: E741
        found[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return sorted(
        (lang, i, phrase.decode(), -a, l, r, totals[lang], -score)
        for lang, rows in found.items()
        for i, (score, a, phrase, l, r) in enumerate(sorted(rows)[:first], 1)  # noqa: E741
    )


def phrase_rows():
    """A word and a pair that hold a third of all words, odd signs, NULLs, one long text."""
    rng = random.Random(6)
    words = ["The", "of", "en", "de", "und", "\u00c9t\u00e9", "\u00e9t\u00e9", "New", "york", "x\u00a0y", "a-b", "1", "aa", "aaa", "\U0001f600"] + [f"w{i}" for i in range(60)]
    signs = [" ", " ", " ", " ", "\t", "  ", ", ", ".", "\n", "\r\n", "!?", "\x0b", "\x85"]

    def text(n):
        out = []
        for _ in range(n):
            out.append(rng.choice(["hot pair", "hot pair again"]) if rng.random() < 0.3 else rng.choice(words))
            out.append(rng.choice(signs))
        return "".join(out)

    rows = [(rng.choice(["en", "en", "de", None, "und", ""]), text(rng.randint(0, 60))) for _ in range(300)]
    return rows + [("en", None), (None, ""), ("en", " \t"), ("en", text(6000)), *[("de", "the same line here")] * 25]


@pytest.mark.parametrize("budget, chunk, bits", [(2_000_000, 2_000_000, 1 << 20), (300, 500, 1 << 20), (2_000, 97, 64)])
def test_collocations_against_brute_force(spark, monkeypatch, budget, chunk, bits):
    """Also where words and pairs pass the budget, chunks are small and the bit table is full."""
    monkeypatch.setattr(phrases, "SMALLEST", 1)
    rows = phrase_rows()
    schema = "lang string, text string, key long, n long, word string, a long, t string"
    df = spark.createDataFrame([(*r, 1, 2, "x", 3, "y") for r in rows], schema).repartition(4)
    got = phrases.collocations(df, least=6, first=40, budget=budget, chunk=chunk, bits=bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = collocations_of(rows, 6, 40)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 50


def test_collocations_of_empty_tables(spark):
    df = spark.createDataFrame([("en", None), (None, "")], "lang string, text string")
    assert phrases.collocations(df).count() == 0 and phrases.collocations(df.filter("false")).count() == 0


def test_ratio_is_exact_beyond_64_bits(spark):
    a, l, r = 10**14 + 7, 10**15 + 1, 10**15 - 1  # noqa: E741
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    assert df.select(phrases._ratio(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 10**6 * a * a // (l * r)


def test_subtree_counts_are_totals_of_leaves():
    rng = np.random.default_rng(1)
    a, b, c = (rng.integers(1, 4, 500).astype(np.uint64) for _ in range(3))
    c[::5] = 0
    n = rng.integers(1, 5, 500)
    leaves = Counter()
    for x, y, z, k in zip(a, b, c, n):
        leaves[x, y] += k
        if z:
            leaves[x, y, z] += k
    got = {tuple(p): t for _, path, total in phrases.subtree([a, b, c], n, 30) for *p, t in zip(*path, total)}
    assert got == {p: t for p, t in leaves.items() if t >= 30}
