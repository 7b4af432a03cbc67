"""The pipeline's stages against brute force on a small corpus."""

import hashlib

import corpus_pipeline
from tests.llm.conftest import words
from tests.llm.test_pairs import brute_classes
from tests.llm.test_texts import SECRET

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    item = words(71, 30)
    good = [" ".join(words(80 + k, 60)) for k in range(8)]
    texts = good + [good[0], good[1] + " tail", None, "", "few words"]  # 8, 9 near copies; 10 to 12 too short
    texts += ["same five words come again " * 20, " ".join(words(99, 30) + item), good[2] + " " + " ".join(words(98, 60)) + f" aws key {SECRET} end"]
    return texts, " ".join(item)


def write(spark, make, folder, texts, items):
    make(texts).select(*COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_run_keeps_clean_documents_once(spark, make, tmp_path):
    texts, item = corpus()
    sf = write(spark, make, tmp_path, texts, [item])
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    classes = brute_classes(texts)
    want = {i for i, least in classes.items() if i == least and i not in (10, 11, 12, 13, 14)}
    assert set(out) == want and 15 in want
    for i in want - {15}:
        assert out[i].text_sha256 == hashlib.sha256(texts[i].encode()).hexdigest() and len(out[i].ids) == out[i].n_tokens


def test_each_stage_returns_the_columns_of_documents(spark, make, tmp_path):
    texts, item = corpus()
    sf = write(spark, make, tmp_path, texts, [item])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "benchmark_free", "secrets_redacted", "encoded"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == COLUMNS, name
        assert stage(spark, docs.limit(0), sf).count() == 0, name


def test_empty_documents(spark, make, tmp_path):
    sf = write(spark, make, tmp_path, [], ["an item"])
    assert corpus_pipeline.run(spark, sf).count() == 0
