"""Queries of trained classifiers of whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartloom.llm import factorisation, string_kernel
from chartloom.llm.common import held_out, table
from chartloom.llm.queries import query


@query("op5_quality_fm")
def op5_quality_fm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = factorisation.fit(factorisation.training_rows(docs, table(spark, sf_dir, "labels"), "quality"))
    return factorisation.scored(docs, machine).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= factorisation.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op6_language_kernel")
def op6_language_kernel(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = string_kernel.fit(string_kernel.training_rows(docs))
    return string_kernel.predicted(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score"
    )
