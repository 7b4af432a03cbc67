"""Trained classifiers: the identity behind the score, odd rows, held-out accuracy."""

import random

from pyspark.sql import functions as F

from chartloom.llm import factorisation, string_kernel
from chartloom.llm.queries import QUERIES, load_all

from tests.llm.conftest import words

SF = "/root/testdata/sf0.01"
load_all()


def labelled(make, spark, n=300):
    rng, good, bad = random.Random(1), words(61, 60), words(62, 60)
    texts = [" ".join(rng.choice(good if i % 2 else bad) for _ in range(40)) for i in range(n)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(n)] + [(None, 1), (10**6, None)], "doc_id long, quality int")
    return make(texts), labels


def test_quality_learns_and_scores_every_row(make, spark, odd_texts):
    docs, labels = labelled(make, spark)
    machine = factorisation.fit(factorisation.training_rows(docs, labels, "quality"))
    rows = factorisation.scored(docs, machine).collect()
    right = sum((r.score >= 0.5) == bool(r.doc_id % 2) for r in rows)
    assert len(rows) == 300 and right >= 285
    odd = factorisation.scored(make(odd_texts), machine).collect()
    assert len(odd) == len(odd_texts) and all(0 <= r.score <= 1 for r in odd)
    assert len({r.score for r in odd if r.doc_id in (4, 5, None)}) == 1


def test_quality_without_labels_or_with_one(make, spark, odd_texts):
    docs, labels = labelled(make, spark, 40)
    for kept, score in (("quality > 5", 0.5), ("quality = 1", 1.0)):
        machine = factorisation.fit(factorisation.training_rows(docs, labels.filter(kept), "quality"))
        assert {r.score for r in factorisation.scored(make(odd_texts), machine).collect()} == {score}
    assert factorisation.scored(docs.limit(0), machine).count() == 0


def test_language_of_odd_rows(make, spark, odd_texts):
    rng = random.Random(2)
    alphabets = {"aa": "abcdef", "bb": "uvwxyz"}
    rows = []
    for i in range(120):
        lang = ("aa", "bb")[i % 2]
        rows.append((i, " ".join("".join(rng.choice(alphabets[lang]) for _ in range(5)) for _ in range(20)), lang))
    docs = spark.createDataFrame(rows + [(500, None, "aa"), (501, "abc", None)], "doc_id long, text string, lang string")
    model = string_kernel.fit(string_kernel.training_rows(docs))
    got = {r.doc_id: r for r in string_kernel.predicted(docs.select("doc_id", "text"), model).collect()}
    assert all(got[i].lang_pred == ("aa", "bb")[i % 2] and 0 <= got[i].score <= 1 for i in range(120))
    odd = string_kernel.predicted(make(odd_texts + [(9, "123 !? 456")]).select("doc_id", "text"), model).collect()
    assert len(odd) == len(odd_texts) + 1
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in odd if r.doc_id in (0, 1, 2, 9))
    nothing = string_kernel.fit(string_kernel.training_rows(docs.limit(0)))
    assert {r.lang_pred for r in string_kernel.predicted(docs.select("doc_id", "text"), nothing).collect()} == {"und"}


def test_held_out_accuracy(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in QUERIES["op6_language_kernel"](spark, SF).collect() if r.held_out and langs[r.doc_id]]
    assert sum(r.lang_pred == langs[r.doc_id] for r in rows) >= 0.9 * len(rows)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality is not None}
    rows = [r for r in QUERIES["op5_quality_fm"](spark, SF).collect() if r.held_out and r.doc_id in quality]
    ones = [r.score for r in rows if quality[r.doc_id] == 1]
    zeros = [r.score for r in rows if quality[r.doc_id] == 0]
    better = sum((a > b) + (a == b) / 2 for a in ones for b in zeros)
    assert better >= 0.8 * len(ones) * len(zeros)


def test_columns_with_the_names_of_results(make):
    docs = make(["good words", "bad words", None]).withColumns({"score": F.lit("x"), "lang_pred": F.lit("y")})
    columns = docs.columns
    for _ in range(2):  # the caller's schema stays as it is
        assert factorisation.scored(docs, 0.5).count() == 3
        assert docs.columns == columns and docs.schema.names == columns
    rows = docs.selectExpr("text", "CASE WHEN text LIKE 'good%' THEN 1 ELSE 0 END AS label").filter("text IS NOT NULL")
    machine = factorisation.fit(rows)
    for _ in range(2):
        assert dict(factorisation.scored(docs, machine).dtypes)["score"] == "double" and docs.schema.names == columns
    model = string_kernel.train(["ab cd", "xy zw"] * 3, ["a", "b"] * 3)
    got = string_kernel.predicted(docs, model).collect()
    assert len(got) == 3 and {r.lang_pred for r in got} <= {"a", "b", "und"}


def test_every_language_has_landmarks():
    langs = [f"l{i:03d}" for i in range(90)]
    texts = [f"word{lang} only{lang}" for lang in langs]
    model = string_kernel.train(texts * 2, langs * 2, landmarks=16)
    assert len(model.landmarks) == 180
