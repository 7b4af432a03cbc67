"""From raw documents to token ids: rules, near-duplicates, benchmark passages, secrets, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs.  The first three drop rows, the
fourth replaces secrets in texts and brings n_chars up to date; all four keep the
columns of documents.  The last gives the ids of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm import bagminhash, byte_bpe, decontaminate, rules, secrets
from chartloom.llm.common import corpus_settings, stored, table
from chartloom.llm.q_text import rank_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule."""
    corpus_settings(spark)
    return rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the least doc_id."""
    corpus_settings(spark)
    return bagminhash.keep_one(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets_redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced."""
    corpus_settings(spark)
    out = secrets.redact(docs, path="source" if "source" in docs.columns else None)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text_sha256): ids of each text, and a hash of the text they decode to."""
    corpus_settings(spark)
    ranks = byte_bpe.read_ranks(rank_file())
    ids = byte_bpe.encode(docs.select("doc_id", "text"), ranks, offsets=False).drop("text")
    return byte_bpe.decode(ids, ranks).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("text_sha256")
    )


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark_free", benchmark_free),
    ("secrets_redacted", secrets_redacted),
    ("encoded", encoded),
]

# BagMinHash, the forest and the tokenizer have no SQL form; tests/llm hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
