"""Queries on the corpus as a whole."""

from __future__ import annotations

from pathlib import Path

from chartloom.llm import merkle, packing, phrases
from chartloom.llm.common import table
from chartloom.llm.queries import query


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op11_phrase_collocations", phrases.SQL)
def op11_phrase_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


@query("op12_nnls_packing")
def op12_nnls_packing(spark, sf_dir):
    spec = Path(tokenizer_file()).read_text()
    return packing.packed(table(spark, sf_dir, "documents").select("doc_id", "text"), spec)


@query("op13_merkle_manifest")
def op13_merkle_manifest(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"))
