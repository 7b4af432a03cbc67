"""Queries on whole texts, one document at a time."""

from __future__ import annotations

from chartloom.llm import byte_bpe, personal, rules, secrets
from chartloom.llm.common import table
from chartloom.llm.queries import query


def rank_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query("op9_byte_bpe")
def op9_byte_bpe(spark, sf_dir):
    ranks = byte_bpe.read_ranks(rank_file())
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = byte_bpe.encode(docs, ranks, offsets=False).drop("text")
    return byte_bpe.digests(byte_bpe.decode(ids, ranks))


@query("op10_quality_rules", rules.SQL)
def op10_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.measured(docs).drop("text")


@query("op8_secret_scan")
def op8_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return secrets.report(docs, path="source")


@query("op7_personal_data")
def op7_personal_data(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return personal.digests(personal.detect(docs))
