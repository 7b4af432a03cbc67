"""Language identification by a string kernel.

A text is the set of its character n-grams of one to `longest` letters and signs (the
blended spectrum, presence only).  The kernel of two texts counts common n-grams over
the root of the product of their numbers.  A number of landmark texts stand for the
kernel (Nyström): a text's kernel values to the landmarks, whitened by the landmark
matrix, are its features, and one ridge regression per language, against the rest,
scores them.  A batch is scored by two matrix products.

Texts are lower-cased; n-grams that no landmark has are left out of the set.  The fit
takes at most `rows_per_lang` texts of each language, chosen by a hash of their id.
NULL texts and texts without a letter are `und` with score 0.  Repeated rows are
predicted alike.  Without training rows everything is `und`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartloom.llm.common import held_out, whole_text

LONGEST = 3
ALPHABET = 64
LANDMARKS = 128
ROWS_PER_LANG = 300
RIDGE = 1e-3
TRAIN_CHARS = 100_000


@dataclass
class Model:
    letters: np.ndarray  # code point to letter number, 0: any other
    grams: list[np.ndarray]  # for each length: code to place in the vocabulary, -1: none
    landmarks: np.ndarray  # landmarks x vocabulary
    weights: np.ndarray  # landmarks x languages
    langs: list[str]

    def presence(self, texts: list[str]) -> np.ndarray:
        return _presence(texts, self.letters, self.grams, self.landmarks.shape[1])

    def kernel(self, present: np.ndarray) -> np.ndarray:
        return _kernel(present, self.landmarks)

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.kernel(self.presence(texts)) @ self.weights


def _codes(texts: list[str], letters: np.ndarray):
    """For each length: row and code of every n-gram."""
    low = [t.lower() for t in texts]
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    c = letters[points].astype(np.int32)
    sizes = np.fromiter(map(len, low), np.int64, len(low))
    row = np.repeat(np.arange(len(low), dtype=np.int32), sizes)
    code = c
    for n in range(1, LONGEST + 1):
        if n > 1:
            code = code[:-1] * ALPHABET + c[n - 1 :] if len(code) > 1 else code[:0]
        k = len(code)
        inside = row[:k] == row[len(row) - k :] if k else np.empty(0, bool)
        yield n, row[:k][inside], code[inside]


def _presence(texts, letters, grams, size) -> np.ndarray:
    out = np.zeros(len(texts) * size, bool)
    for n, row, code in _codes(texts, letters):
        at = grams[n - 1][code]
        known = at >= 0
        out[row[known].astype(np.int64) * size + at[known]] = True
    return out.reshape(len(texts), size).astype(np.float32)


def _kernel(present: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    common = present @ landmarks.T
    norm = np.sqrt(np.maximum(present.sum(axis=1), 1)[:, None] * np.maximum(landmarks.sum(axis=1), 1)[None, :])
    return common / norm


def train(texts: list[str], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    names = sorted(set(langs))
    landmarks = max(landmarks, 2 * len(names))
    y = np.array([names.index(x) for x in langs])
    turns = [np.flatnonzero(y == k) for k in range(len(names))]
    chosen = [t[i] for i in range(max(map(len, turns))) for t in turns if i < len(t)][:landmarks]
    marks = [texts[i] for i in chosen]
    points, counts = np.unique(np.frombuffer("".join(m.lower() for m in marks).encode("utf-32-le", "surrogatepass"), np.uint32), return_counts=True)
    letters = np.zeros(0x110000, np.uint8)
    common = points[np.argsort(-counts, kind="stable")][: ALPHABET - 1]
    letters[common] = np.arange(1, len(common) + 1)
    grams, size = [], 0
    for n, _, code in _codes(marks, letters):
        found = np.unique(code)
        at = np.full(ALPHABET**n, -1, np.int32)
        at[found] = size + np.arange(len(found))
        grams.append(at)
        size += len(found)
    base = _presence(marks, letters, grams, size)
    values, vectors = np.linalg.eigh(_kernel(base, base).astype(float))
    good = values > 1e-6
    whiten = vectors[:, good] / np.sqrt(values[good])
    features = np.concatenate(
        [_kernel(_presence(texts[i : i + 256], letters, grams, size), base) @ whiten for i in range(0, len(texts), 256)]
    )
    target = np.where(y[:, None] == np.arange(len(names)), 1.0, -1.0)
    inner = features.T @ features + ridge * len(texts) * np.eye(features.shape[1])
    return Model(letters, grams, base, whiten @ np.linalg.solve(inner, features.T @ target), names)


def training_rows(docs: DataFrame, rows_per_lang: int = ROWS_PER_LANG, longest: int = TRAIN_CHARS) -> DataFrame:
    """Rows to learn from: per language the first by a hash of the id, without very long texts; a repeated id once."""
    first = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = docs.filter(F.col("lang").isNotNull() & ~held_out() & whole_text().rlike(r"\p{L}") & (F.length("text") <= longest)).select("doc_id", "lang")
    chosen = ids.withColumn("__n", F.row_number().over(first)).filter(F.col("__n") <= rows_per_lang).select("doc_id").distinct()
    rows = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & (F.length("text") <= longest))
    some = rows.join(F.broadcast(chosen), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return some.orderBy(F.xxhash64("doc_id"), F.xxhash64("text"))


def fit(rows: DataFrame, **options) -> Model | None:
    got = rows.select(whole_text("text").alias("t"), "lang").toArrow()
    return train(got.column(0).to_pylist(), got.column(1).to_pylist(), **options) if len(got) else None


def predicted(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """docs with lang_pred and score; columns of these names are replaced."""
    docs = docs.drop("lang_pred", "score")
    none = docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    if model is None:
        return none
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    extra = docs.withColumns({"__t": whole_text(text), "__has": whole_text(text).rlike(r"\p{L}")})

    def run(batches):
        m = shared.value
        for b in batches:
            texts, has = b.column(len(names)).to_pylist(), b.column(len(names) + 1).to_numpy(zero_copy_only=False)
            langs, best = [], []
            for i in range(0, len(texts), 128):
                s = m.scores(texts[i : i + 128])
                top = s.argmax(axis=1)
                langs += [m.langs[k] for k in top]
                best.append(np.clip((s[np.arange(len(top)), top] + 1) / 2, 0, 1))
            score = np.concatenate(best) if best else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [
                    *b.columns[: len(names)],
                    pa.array([lang if ok else "und" for lang, ok in zip(langs, has)], pa.string()),
                    pa.array(np.where(has, score, 0.0) if len(has) else score, pa.float64()),
                ],
                [*names, "lang_pred", "score"],
            )

    return extra.mapInArrow(run, none.schema)
