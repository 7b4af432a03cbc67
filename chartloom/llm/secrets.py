"""Secret scan: candidates from patterns, false positives removed by a random forest.

Candidates are long runs of key characters that hold a digit, and whatever is
assigned to a name such as password or token.  Each gets features: its length and
spread of characters, transitions between character classes, how much of it
dictionary words cover, its path, and the words next to it.  The forest is fitted on
labelled findings; `weak_label` makes some from the corpus: formats of providers and
values of mixed signs assigned to a secret's name, against words and numbers; mixed
values that no name announces have no label and are judged.  What that rule looks at
(the name, the sign of assignment, the format) is in no feature: the forest judges a
value by its make, its path and the other words near it.

The fit takes at most `train_rows` findings, chosen by hash; a fifth of the values
take no part in it and are left for measuring (`held_out_value`).  The dictionary are
the words of all texts that occur `max(3, texts / DICTIONARY_SHARE)` times, so it has
at most DICTIONARY_SHARE x (words of a text on average) words, in practice some
thousands, at any size.  Scores cover every candidate of every text.

NULL texts are empty.  Texts without candidates give no findings.  Repeated rows
give their findings each.  Without both labels all findings are kept, scored 1.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import stored, whole_text, words_of
from chartloom.llm.graph import attach

TRAIN_ROWS = 20_000
DICTIONARY_SHARE = 2_000
NEAR = 8  # hash places of neighbouring words
MARK = "[SECRET]"

# Names that secrets are assigned to, words near samples.
NAMES = r"passw(?:or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth"
DUMMY = ("example", "sample", "dummy", "test", "placeholder", "changeme", "your")

_RUN = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
_ASSIGNED = re.compile(rf"(?i)(?:{NAMES})\s*[:=]\s*[\"']?([^\s\"'=]{{6,}})")
_NAME = re.compile(rf"(?i)(?:{NAMES})")
_IS_NAMED = re.compile(rf"(?i)(?:{NAMES})\s*[:=]\s*[\"']?$")
_PROVIDER = re.compile(r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,})$")
# A part is mixed unless it is one word, capitalised or not, or one number.
_PARTS, _MIXED = re.compile(r"[^A-Za-z0-9]+"), re.compile(r"(?!(?:[A-Z]?[a-z]*|[A-Z]*|[0-9]*)$)")
_TRIM = "=-_/+.,;:!?*#$%&)('\""


def spans(text: str) -> list[tuple[int, int]]:
    """Candidates of a text, sorted; of overlapping ones the first and longest."""
    found = set()
    for m in _RUN.finditer(text):
        s, e = m.span()
        run = m.group()
        inner = run.lstrip("=-_/+")
        if "=" in inner.rstrip("="):
            s, inner = s + run.rindex("=", 0, len(run.rstrip("="))) + 1, inner.rstrip("=").rpartition("=")[2]
        else:
            s = e - len(inner)
        inner = inner.rstrip("-_/+")
        if len(inner) >= 12 and any(c.isdigit() for c in inner):
            found.add((s, s + len(inner)))
    for m in _ASSIGNED.finditer(text):
        s, value = m.start(1), m.group(1).rstrip(_TRIM)
        if len(value) >= 6:
            found.add((s, s + len(value)))
    out: list[tuple[int, int]] = []
    for s, e in sorted(found, key=lambda x: (x[0], -x[1])):
        if not out or s >= out[-1][1]:
            out.append((s, e))
    return out


def _kind(c: str) -> int:
    return 0 if c.isupper() else 1 if c.islower() else 2 if c.isdigit() else 3


def covered(value: str, known: frozenset[str]) -> float:
    """Share of the candidate that dictionary words of three letters or more cover."""
    low, n, reach, total = value.lower(), len(value), 0, 0
    for i in range(n):
        for k in range(min(12, n - i), 2, -1):
            if low[i : i + k] in known:
                total += max(0, i + k - max(reach, i))
                reach = max(reach, i + k)
                break
    return total / max(n, 1)


def features(text: str, start: int, end: int, path: str, known: frozenset[str]) -> list[float]:
    value = text[start:end]
    n = len(value)
    counts = Counter(value)
    kinds = [_kind(c) for c in value]
    moves = Counter(zip(kinds, kinds[1:]))
    before, after = text[max(0, start - 48) : start], text[end : end + 24]
    near = [w.strip(_TRIM).lower() for w in re.split(r"\s+", before)[-4:] + re.split(r"\s+", after)[:3]]
    near = [w for w in near if w and not _NAME.search(w)]
    beside = [0.0] * NEAR
    for w in near:
        beside[zlib.crc32(w.encode()) % NEAR] = 1.0
    steps = re.split(r"\W+", path.lower())
    return [
        math.log2(n + 1),
        len(counts) / n,
        -sum(c / n * math.log2(c / n) for c in counts.values()),
        *(moves[a, b] / max(n - 1, 1) for a in range(4) for b in range(4)),
        covered(value, known),
        sum(c in "0123456789abcdefABCDEF" for c in value) / n,
        *beside,
        float(any(w.startswith(DUMMY) for w in near)),
        float(any(s in ("test", "tests", "docs", "doc", "examples", "example") for s in steps)),
        float(any(s in ("env", "config", "conf", "secrets", "deploy", "yml", "yaml", "ini") for s in steps)),
    ]


def weak_label(text: str, start: int, end: int) -> int | None:
    """1: a provider's format, or a value of mixed signs assigned to a secret's name; 0: words and numbers; else None."""
    value = text[start:end]
    if _PROVIDER.match(value):
        return 1
    if value.lower().startswith(DUMMY) or not any(_MIXED.match(part) for part in _PARTS.split(value)):
        return 0
    spread = len(value) >= 8 and len(set(value)) >= 6
    return 1 if spread and _IS_NAMED.search(text[max(0, start - 32) : start]) else None


def held_out_value(value: str = "value") -> Column:
    """A fifth of the values, which the forest is not fitted on."""
    return F.pmod(F.xxhash64(F.lit("apart"), value), F.lit(5)) == 0


def key_of(text: str, path: str | None) -> Column:
    parts = [whole_text(text)] if path is None else [F.coalesce(F.col(path), F.lit("")), whole_text(text)]
    return F.unhex(F.md5(F.concat_ws("\n", *parts)))


def dictionary(docs: DataFrame, text: str = "text", share: int = DICTIONARY_SHARE) -> list[str]:
    """Lower-case words of three to twelve letters that occur max(3, texts / share) times in all texts."""
    words = docs.select(F.explode(words_of(F.lower(whole_text(text)))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    least = max(3, -(-docs.count() // share))
    common = words.filter((F.col("n") >= least) & F.col("w").rlike(r"^\p{L}{3,12}$"))
    return sorted(r["w"] for r in common.select("w").collect())


def findings(docs: DataFrame, text: str = "text", path: str | None = None, known: list[str] = ()) -> DataFrame:
    """(key, start, end, value, label, features) of every candidate; key is key_of(text, path)."""
    words = docs.sparkSession.sparkContext.broadcast(frozenset(known))
    some = docs.select(
        key_of(text, path).alias("key"),
        whole_text(text).alias("t"),
        (F.coalesce(F.col(path), F.lit("")) if path else F.lit("")).alias("path"),
    ).filter(F.col("t").rlike(f"[0-9]|(?i:{NAMES})"))

    def run(batches):
        for batch in batches:
            out = []
            for key, t, where in zip(*(c.to_pylist() for c in batch.columns)):
                out += [
                    (key, s, e, t[s:e], weak_label(t, s, e), features(t, s, e, where, words.value)) for s, e in spans(t)
                ]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("key", "start", "end", "value", "label", "features"), x)) for x in out],
                schema=pa.schema(
                    [
                        ("key", pa.binary()),
                        ("start", pa.int32()),
                        ("end", pa.int32()),
                        ("value", pa.string()),
                        ("label", pa.int32()),
                        ("features", pa.list_(pa.float64())),
                    ]
                ),
            )

    return some.mapInArrow(run, "key binary, start int, end int, value string, label int, features array<double>")


def fit(labelled: DataFrame, train_rows: int = TRAIN_ROWS, trees: int = 20, depth: int = 6):
    """Forest from distinct labelled findings, both labels alike in weight; None with one label only."""
    sample = stored(
        labelled.filter(F.col("label").isNotNull() & ~held_out_value()).dropDuplicates(["value", "label"]).orderBy(F.xxhash64("value"), "value", "label").limit(train_rows), "labelled"
    )
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    weight = F.when(F.col("label") == 1, 0.5 / counts[1]).otherwise(0.5 / counts[0]) * sum(counts.values())
    rows = sample.select(array_to_vector("features").alias("x"), F.col("label").cast("double"), weight.alias("weight"))
    forest = RandomForestClassifier(
        featuresCol="x", labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth, seed=11
    )
    return forest.fit(rows)


def scored(found: DataFrame, forest) -> DataFrame:
    """(key, start, end, value, score) of the findings."""
    if forest is None:
        return found.select("key", "start", "end", "value", F.lit(1.0).alias("score"))
    out = forest.setFeaturesCol("x").transform(found.withColumn("x", array_to_vector("features")))
    return out.select("key", "start", "end", "value", vector_to_array("probability")[1].alias("score"))


def scan(docs: DataFrame, text: str = "text", path: str | None = None, **options) -> DataFrame:
    """Scored findings of all texts, a row for each distinct (text, path)."""
    found = stored(findings(docs, text, path, dictionary(docs, text)), "findings")
    return scored(found, fit(found.select("value", "label", "features"), **options)).dropDuplicates(["key", "start"])


def report(docs: DataFrame, text: str = "text", path: str | None = None, threshold: float = 0.5, **options) -> DataFrame:
    """(doc_id, start, end, value, score, is_secret) of every finding of every row."""
    found = stored(scan(docs, text, path, **options), "scored")
    rows = docs.select("doc_id", key_of(text, path).alias("key"))
    return attach(rows, found, "key").select(
        "doc_id", "start", "end", "value", F.round("score", 6).alias("score"), (F.col("score") >= threshold).alias("is_secret")
    )


def redact(docs: DataFrame, text: str = "text", path: str | None = None, threshold: float = 0.5, **options) -> DataFrame:
    """docs with each secret replaced by MARK; other rows and columns stay."""
    found = scan(docs, text, path, **options).filter(F.col("score") >= threshold)
    per_text = stored(
        found.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__cuts")), "secrets"
    )
    whole = F.col(text)
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    replaced = F.aggregate(
        "__cuts",
        start,
        lambda done, cut: F.struct(
            F.concat(done["out"], F.substr(whole, done["at"] + 1, cut["start"] - done["at"]), F.lit(MARK)).alias("out"),
            cut["end"].alias("at"),
        ),
        lambda done: F.concat(done["out"], F.substr(whole, done["at"] + 1)),
    )
    joined = attach(docs.withColumn("__key", key_of(text, path)), per_text.withColumnRenamed("key", "__key"), "__key", "left")
    cleaned = joined.withColumn(text, F.when(F.col("__cuts").isNull(), whole).otherwise(replaced))
    return cleaned.select(*docs.columns)
