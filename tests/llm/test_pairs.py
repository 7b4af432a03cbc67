"""Operators that compare rows, against brute force."""

import collections
import itertools
import random

import duckdb
import numpy as np
import pytest

from chartloom.llm import bagminhash, decontaminate, graph, passages, revisits

from tests.llm.conftest import words


def mutated(text, seed, share):
    rng = random.Random(seed)
    return " ".join(f"new{rng.randint(0, 10**6)}" if rng.random() < share else w for w in text.split())


def bag_of(text):
    w = (text or "").split()
    runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []
    return collections.Counter(runs)


def jaccard(a, b):
    if not a or not b:
        return float(not a and not b)
    return sum((a & b).values()) / sum((a | b).values())


def brute_classes(texts):
    """Least id of each component; shares within a margin of the threshold are kept out of the fixtures."""
    bags, parent = [bag_of(t) for t in texts], list(range(len(texts)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if jaccard(bags[i], bags[j]) >= 0.8:
            a, b = sorted((top(i), top(j)))
            parent[b] = a
    return {i: top(i) for i in range(len(texts))}


@pytest.fixture(scope="module")
def near_texts():
    out = []
    for k in range(12):
        base = " ".join(words(100 + k, 120))
        out += [base, base, mutated(base, k, 0.008), mutated(base, 50 + k, 0.3)]
        out.append(" ".join([base] * 2))  # the same set of shingles, but another multiset
    return out + [None, "", " ", "one two", "one two", "one three"]


def test_bagminhash_classes_match_brute_force(make, near_texts):
    got = {r.doc_id: r.class_id for r in bagminhash.class_ids(make(near_texts)).collect()}
    assert got == brute_classes(near_texts)


def test_bagminhash_links_a_large_group_in_rounds(make):
    base = " ".join(words(9, 200))
    texts = [mutated(base, k, 0.006) for k in range(150)] + [" ".join(words(1000 + k, 80)) for k in range(20)]
    got = {r.doc_id: r.class_id for r in bagminhash.class_ids(make(texts), leaders_a_round=2).collect()}
    assert got == brute_classes(texts)


def similar_pairs(texts, least=0.8):
    """All pairs of different texts at or above the similarity, from an index of shingles."""
    bags, index, shared = [bag_of(t) for t in texts], collections.defaultdict(list), collections.Counter()
    for i, bag in enumerate(bags):
        for shingle in bag:
            index[shingle].append(i)
    for shingle, places in index.items():
        for i, j in itertools.combinations(places, 2):
            shared[i, j] += min(bags[i][shingle], bags[j][shingle])
    total = [sum(b.values()) for b in bags]
    return [(i, j) for (i, j), n in shared.items() if n >= least * (total[i] + total[j] - n)]


def test_bagminhash_recall_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    first = {}
    for r in rows:
        first.setdefault(r.text or "", r.doc_id)
    texts = list(first)
    pairs = similar_pairs(texts)
    label = {r.doc_id: r.class_id for r in bagminhash.class_ids(docs).collect()}
    together = sum(label[first[texts[i]]] == label[first[texts[j]]] for i, j in pairs)
    assert pairs and together == len(pairs)
    assert all(label[r.doc_id] == label[first[r.text or ""]] for r in rows)


def test_bagminhash_keeps_one_of_each_class(make, near_texts, odd_texts):
    docs = make(near_texts)
    kept = bagminhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute_classes(near_texts).values()))
    assert sorted(r.doc_id for r in bagminhash.keep_one(make(odd_texts)).collect()) == [0, 3, 4, 6]


def test_bagminhash_estimates_weighted_jaccard():
    rng, registers = np.random.default_rng(4), 4096
    items = rng.integers(0, 2**63, 40).astype(np.uint64)
    a, b = rng.integers(1, 30, 40), rng.integers(1, 30, 40)
    s = bagminhash.signatures(np.tile(items, 2), np.concatenate([a, b]), np.repeat([0, 1], 40), 2, registers)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((s[0] == s[1]).mean() - true) < 4 * np.sqrt(true * (1 - true) / registers)


def benchmark_of(spark, items):
    return spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


def test_decontamination_matches_sql(spark, make):
    item = words(21, 40)
    near = [w if i % 9 else f"sub{i}" for i, w in enumerate(item)]
    around = words(22, 60)
    texts = [" ".join(around), " ".join(around[:20] + item + around[20:]), " ".join(around[:9] + near), " ".join(item[:5] + around)]
    texts += [None, "", " ".join(item), " ".join(item)]
    items = [" ".join(item), " ".join(item), " ".join(words(23, 12)), None, "", "too short"]
    docs, bench = make(texts), benchmark_of(spark, items)
    con = duckdb.connect()
    documents, benchmark = docs.select("doc_id", "text").toPandas(), bench.toPandas()
    con.register("documents", documents)
    con.register("benchmark", benchmark)
    result = con.execute(decontaminate.SQL)
    columns = [d[0] for d in result.description]
    want = sorted(result.fetchall())
    assert sorted(tuple(r) for r in decontaminate.report(docs, bench).select(*columns).collect()) == want
    assert {r[0] for r in want} == {1, 2, 6, 7}
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 3, 4, 5]


@pytest.mark.parametrize("n", [5, 7, 8, 9, 10, 11, 12, 13])
def test_decontamination_finds_every_allowed_substitution(spark, make, n):
    """All sets of places that may differ, for short items too; one more change hides the item."""
    item = words(300 + n, n)
    free = n - -(-8 * n // 10)
    around = words(77, 30)
    gone = [g for k in (free, free + 1) for g in itertools.combinations(range(n), k)]
    texts = [" ".join(around[:11] + [f"other{i}" if i in g else w for i, w in enumerate(item)] + around[11:]) for g in gone]
    got = {r.doc_id for r in decontaminate.report(make(texts), benchmark_of(spark, [" ".join(item)])).collect()}
    assert got == {i for i, g in enumerate(gone) if len(g) <= free}


def test_decontamination_of_very_short_items(spark, make):
    """Whole texts only, whatever the white space; and as they are a run of prose they are left alone."""
    texts = ["yes", " yes\n", "oh yes", "one two three four", "one  two three four", "one two three four five", "Yes", None, ""]
    items = ["yes", "one two three four", "", None]
    got = {(r.doc_id, r.item_id) for r in decontaminate.report(make(texts), benchmark_of(spark, items)).collect()}
    assert got == {(0, 0), (1, 0), (3, 1), (4, 1)}


def test_decontamination_of_empty_and_odd_tables(spark, make, odd_texts):
    docs, bench = make(odd_texts), benchmark_of(spark, ["a " * 20])
    assert decontaminate.clean(docs, bench.limit(0)).count() == len(odd_texts)
    assert decontaminate.clean(docs.limit(0), bench).count() == 0
    assert decontaminate.clean(docs, bench).count() == len(odd_texts)


def test_passages_are_found_and_clean_texts_left_alone(make):
    shared = words(31, 70)
    fuzzy = [w if i % 17 else f"odd{i}" for i, w in enumerate(shared)]
    own = [words(40 + k, 90) for k in range(5)]
    texts = [own[0][:30] + shared + own[0][30:], shared + own[1], own[2] + fuzzy, own[3], own[4] + shared[:30]]
    docs = make([" ".join(t) for t in texts] + [None, "", " ".join(texts[3])])
    rows = passages.repeated(docs).collect()
    # The first place of a seed is that of the least text hash, so any of the three texts may be named by the others.
    heads = {r.other_id for r in rows if r.doc_id != 7}
    (head,) = heads
    assert {(r.doc_id, r.other_id) for r in rows} == {(7, 3)} | {(i, head) for i in {0, 1, 2} - heads}
    place = {0: 30, 1: 0, 2: 90}
    for r in rows:
        if r.doc_id == 7:
            continue
        assert r.end - r.start >= 60 and r.other_end - r.other_start >= 60 and r.same_words <= r.end - r.start
        for i, start, end in ((r.doc_id, r.start, r.end), (r.other_id, r.other_start, r.other_end)):
            assert place[i] <= start and end <= place[i] + 70
        if 2 not in (r.doc_id, r.other_id):
            assert (r.end - r.start, r.other_end - r.other_start, r.same_words) == (70, 70, 70)
    gone = {r.doc_id: r.text.split() for r in passages.cut(docs, passages.repeated(docs)).collect() if r.text}
    assert gone[head] == texts[head] and gone[3] == texts[3]
    assert all(len(gone[i]) <= len(texts[i]) - 60 for i in {0, 1, 2} - heads)


def test_passages_of_odd_rows(make, odd_texts):
    pairs = {(r.doc_id, r.other_id) for r in passages.repeated(make([x for x in odd_texts if x[0] is not None])).collect()}
    assert pairs <= {(5, 4), (5, 5), (4, 5)}
    assert passages.repeated(make(odd_texts).limit(0)).count() == 0


RECORDS = "record_id long, url string, time long, status int, headers map<string,string>, extra string"


def test_revisits_match_a_plain_search(spark):
    rng = random.Random(6)
    rows = []
    for i in range(400):
        headers = {k: v for k, v in (("ETag", f'"{rng.randint(0, 2)}"'), ("Last-Modified", f"d{rng.randint(0, 2)}")) if rng.random() < 0.7}
        url = rng.choice(["http://a.org/x", "https://www.A.org/x/", "http://b.org/", "http://c.org/q?utm_source=z&b=1"])
        rows.append((i, url, rng.choice([None, *range(60)]), rng.choice([200, 304, 304, 404]), headers, "x"))
    rows += [(1000, None, 5, 304, {}, "x"), (1001, "", 5, 304, None, "x"), (1002, None, 1, 200, {}, "x")]
    place = {"http://a.org/x": 0, "https://www.A.org/x/": 0, "http://b.org/": 1, "http://c.org/q?utm_source=z&b=1": 2}
    want = {}
    for i, url, t, status, headers, _ in rows:
        if status != 304:
            continue
        at = (-1 if t is None else t, i)
        full = [
            ((-1 if u is None else u, j), h)
            for j, v, u, s, h, _ in rows
            if s == 200 and url and v and place[v] == place[url] and (-1 if u is None else u, j) < at
        ]
        if not full:
            want[i] = (None, "missing")
            continue
        (_, j), h = max(full, key=lambda x: x[0])
        state = "unchecked"
        for name in ("ETag", "Last-Modified"):
            if name in headers and name in h:
                state = "confirmed" if headers[name] == h[name] else "changed"
                break
        want[i] = (j, state)
    df = spark.createDataFrame(rows, RECORDS).repartition(3)
    for stretches in (2, 16):
        got = {r.record_id: (r.response_id, r.state) for r in revisits.resolved(df, stretches).collect()}
        assert got == want
    assert revisits.resolved(df.limit(0)).count() == 0
    assert revisits.with_payload(revisits.resolved(df), df, "extra").count() == len(want)


def test_revisit_header_names_that_differ_in_case(spark):
    rows = [(1, "http://a/x", 1, 200, {"ETag": "1", "etag": "2", " Etag": None}), (2, "http://a/x", 2, 304, {"ETAG": "2"})]
    df = spark.createDataFrame(rows, "record_id long, url string, time long, status int, headers map<string,string>")
    (r,) = revisits.resolved(df).collect()
    assert r.state == "confirmed" and r.response_id == 1 and r.headers["etag"] == "2"


def test_passages_across_gaps(make):
    """Two shared passages stay two, however many other words lie between them."""
    first, second = words(500, 200), words(501, 200)
    for gap, other in ((10, 10), (28, 28), (100, 160), (300, 300), (2000, 1500)):
        a = first + words(600 + gap, gap) + second
        b = words(700, 30) + first + words(800 + gap, other) + second
        found = passages.repeated(make([" ".join(a), " ".join(b)])).collect()
        covered = {i for r in found for i in range(r.start, r.end)} if found and found[0].doc_id == 0 else {i - 30 for r in found for i in range(r.start, r.end)}
        at = 200 + (gap if found and found[0].doc_id == 0 else other)
        assert len(covered & set(range(200))) >= 195 and len(covered & set(range(at, at + 200))) >= 195, gap


def test_passages_of_runs_with_many_gaps(make):
    """Runs that are long enough alone, in a chain that agrees too seldom as a whole."""
    runs = [words(900 + k, 60) for k in range(5)]
    a, b = [], []
    for k, run in enumerate(runs):
        a += run + words(950 + k, 28)
        b += run + words(980 + k, 28)
    found = passages.repeated(make([" ".join(a), " ".join(b)])).collect()
    covered = {i for r in found for i in range(r.start, r.end)}
    assert sum(len(covered & set(range(88 * k, 88 * k + 60))) for k in range(5)) >= 290


def test_revisit_headers_merge_permitted_names(spark):
    rows = [
        (1, "http://a.org", 1, 200, {"ETag": '"v"', "Content-Type": "text/html", "Cache-Control": "old"}, ""),
        (2, "http://a.org/", 2, 304, {"etag": 'W/"v"', "cache-control": "new", "Content-Length": "0"}, ""),
    ]
    (r,) = revisits.resolved(spark.createDataFrame(rows, RECORDS)).collect()
    assert r.state == "confirmed" and r.headers == {"etag": 'W/"v"', "content-type": "text/html", "cache-control": "new"}


def bridged(seed, n):
    """Two groups of n texts that only the link of two members of them joins."""
    a = words(seed, 200)

    def changed(text, k, tag):
        return [f"{tag}{i}" if i in {10 + 23 * j for j in k} else w for i, w in enumerate(text)]

    x, y, b = (changed(a, range(m), "b") for m in (3, 6, 8))
    out = [" ".join(x), " ".join(y)]
    for side, text in (("p", a), ("q", b)):
        out += [" ".join(w if i != 1 + k % 7 else f"{side}{k}" for i, w in enumerate(text)) for k in range(n)]
    return out


def test_bagminhash_loses_no_link_between_texts_linked_elsewhere(make):
    """The two that join the groups have leaders of their own in the buckets they share."""
    texts = [t for k in range(8) for t in bridged(2000 + k, 15)]
    want = brute_classes(texts)
    assert len(set(want.values())) == 8
    got = bagminhash.class_ids(make(texts), bands=4, rows=1, leaders_a_round=2).collect()
    assert {r.doc_id: r.class_id for r in got} == want


def test_keys_that_may_be_wanted(spark):
    rows = spark.range(5000).select(graph.F.md5(graph.F.col("id").cast("string")).alias("k"), "id")
    wanted = rows.filter("id % 7 = 0").select("k")
    got = {r.id for r in graph.maybe_in(rows, wanted, "k").collect()}
    assert set(range(0, 5000, 7)) <= got and len(got) < 800
    assert graph.maybe_in(rows, wanted.limit(0), "k").count() == 0


def test_passages_whose_seeds_all_start_in_other_texts(make):
    """Two texts share 80 words; many have either half, too short a passage, and most seeds are first found there."""
    texts = []
    for k in range(4):
        p = words(3000 + k, 80)
        own = [words(3100 + 40 * k + i, 30) for i in range(26)]
        texts += [" ".join(own[0] + p), " ".join(own[1] + p + own[25])]
        texts += [" ".join(own[2 + i] + (p[:43] if i < 12 else p[37:])) for i in range(23)]
    found = {tuple(sorted((r.doc_id, r.other_id))): r for r in passages.repeated(make(texts)).collect()}
    assert set(found) == {(25 * k, 25 * k + 1) for k in range(4)}
    assert all(r.end - r.start == r.same_words == 80 for r in found.values())


def test_passages_compare_few_pairs_of_texts_with_a_common_line(make, monkeypatch):
    """Texts with a line in common meet only if they go on alike beside it, by other seeds or not."""
    line, tail = words(4000, 24), words(4001, 36)
    texts = [words(4100 + i, 40) + line + words(4400 + i, 40) for i in range(150)]
    texts[70][64:] = tail
    texts[120][64:] = [w if i % 5 else f"odd{i}" for i, w in enumerate(tail, 1)]
    texts[30][4:40] = [w if i % 5 else f"even{i}" for i, w in enumerate(tail)]
    texts[140][4:40] = tail
    chained_pairs, met = passages.chained_pairs, []

    def counted(pairs, *rest):
        met.append(pairs.count())
        return chained_pairs(pairs, *rest)

    monkeypatch.setattr(passages, "chained_pairs", counted)
    found = passages.repeated(make([" ".join(t) for t in texts])).collect()
    assert {tuple(sorted((r.doc_id, r.other_id))) for r in found} == {(70, 120), (30, 140)}
    assert all(r.end - r.start >= 50 for r in found)
    assert sum(met) < 4000  # of 11,175 pairs


def test_passages_compare_a_pair_of_texts_once(make, monkeypatch):
    line = words(4000, 24)
    texts = [words(4100 + i, 40) + line + words(4400 + i, 40) for i in range(20)]
    texts[5][64:] = texts[12][64:]
    chained_pairs, met = passages.chained_pairs, []

    def counted(pairs, *rest):
        met.extend(map(tuple, pairs.collect()))
        return chained_pairs(pairs, *rest)

    monkeypatch.setattr(passages, "chained_pairs", counted)
    found = passages.repeated(make([" ".join(t) for t in texts])).collect()
    assert {tuple(sorted((r.doc_id, r.other_id))) for r in found} == {(5, 12)}
    assert met and len(met) == len(set(met))


def test_bagminhash_compares_few_pairs_of_a_large_group(make, monkeypatch):
    """Copies that share buckets but are not similar are told apart by their rare shingles."""
    base, rng = words(77, 150), random.Random(5)
    texts = [" ".join(f"odd{rng.randint(0, 2)}" if rng.random() < 0.035 else w for w in base) for _ in range(300)]
    compared, met = bagminhash.compared, []

    def counted(pairs, known):
        met.append(pairs.count())
        return compared(pairs, known)

    monkeypatch.setattr(bagminhash, "compared", counted)
    got = {r.doc_id: r.class_id for r in bagminhash.class_ids(make(texts)).collect()}
    want = brute_classes(texts)
    assert got == want and len(set(want.values())) > 50
    assert sum(met) < 20 * len(texts)


def test_bagminhash_candidates_hold_all_similar_pairs(spark):
    """Multisets of many sizes around the similarity, some in one label."""
    rng = np.random.default_rng(8)
    bags = []
    for base in (np.arange(40), np.repeat(np.arange(100, 130), 2), np.arange(20, 65)):
        for _ in range(30):
            gone = rng.random(len(base)) < rng.choice([0.02, 0.08, 0.15])
            bags.append(np.sort(np.r_[base[~gone], rng.integers(500, 540, rng.integers(0, 6))]))
    bags += [np.array([1]), np.array([1, 1]), np.array([7])]
    rows = [(bytes([i]), bytes([i % 3 if i < 30 else i]), b.astype(np.int64).tobytes()) for i, b in enumerate(bags)]
    df = spark.createDataFrame(rows, "fp binary, label binary, items binary").repartition(3)
    got = {(r.fp[0], r.leader[0]) for r in bagminhash.candidates(df, 0.8).collect()}
    similar = {
        (i, j)
        for i, j in itertools.combinations(range(len(bags)), 2)
        if rows[i][1] != rows[j][1] and bagminhash.weighted_jaccard(bags[i].astype(np.uint64), bags[j].astype(np.uint64)) >= 0.8
    }
    assert len(similar) > 50 and similar <= got
