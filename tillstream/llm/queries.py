"""The registered queries of the numbered operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillstream.llm import (
    bpe, decontaminate, fim, hard_negatives, language, line_dedup, ngram_join, ngram_lm, quality, secret_scan,
    suffix_dedup, token_files, toxicity,
)
from tillstream.llm.words import read_documents

Query = Callable[[SparkSession, str], DataFrame]

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def on_documents(operator: Callable[..., DataFrame], *more: str | int) -> Query:
    return lambda spark, sf_dir: operator(read_documents(spark, sf_dir), *more)


def on_embeddings(operator: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def registry() -> dict[str, Query]:
    return {
        "op1_decontaminate": decontaminate.op1_decontaminate,
        "op2_quality_rules": on_documents(quality.op2_quality_rules),
        "op3_language_id": on_documents(language.op3_language_id),
        "op4_secret_scan": on_documents(secret_scan.op4_secret_scan),
        "op5_ngram_join": on_documents(ngram_join.op5_ngram_join),
        "op6_bpe": on_documents(bpe.op6_bpe, WORD_BPE),
        "op7_token_files": on_documents(token_files.op7_token_files, BYTE_BPE),
        "op8_toxicity": toxicity.op8_toxicity,
        "op9_line_dedup": on_documents(line_dedup.op9_line_dedup),
        "op10_ngram_lm": on_documents(ngram_lm.op10_ngram_lm, 3),
        "op11_hard_negatives": on_embeddings(hard_negatives.op11_hard_negatives),
        "op12_suffix_dedup": on_documents(suffix_dedup.op12_suffix_dedup),
        "op13_fim": on_documents(fim.op13_fim),
    }
