"""Queries that compare documents with each other or with another table."""

from __future__ import annotations

from chartloom.llm import bagminhash, decontaminate, passages
from chartloom.llm.common import table
from chartloom.llm.queries import query


@query("op4_decontaminate", decontaminate.SQL)
def op4_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.report(docs, table(spark, sf_dir, "benchmark"))


@query("op3_bagminhash")
def op3_bagminhash(spark, sf_dir):
    return bagminhash.class_ids(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op1_passages")
def op1_passages(spark, sf_dir):
    return passages.repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
