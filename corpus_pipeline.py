"""The corpus pipeline: quality rules, line dedup, near duplicates, decontamination, token ids.

Each stage takes (spark, docs, sf_dir) and works on all documents the one before kept. All but the last return the
columns of ``documents``; null texts pass through line dedup as they are, and rows without doc_id are never taken
for copies or contaminated. A document is a doc_id: repeated rows of one that stays stay.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import bpe, decontaminate, line_dedup, ngram_join, quality
from tillstream.llm.arrays import shared_folder
from tillstream.llm.components import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive rules keep."""
    return quality.judge(docs).where("kept").select(docs.columns)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds are cut; n_chars follows the text."""
    short = line_dedup.dedup_lines(docs)
    return short.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least doc_id."""
    copies = ngram_join.component_table(docs.select("doc_id", "text")).where("component_id <> doc_id")
    copies = copies.select(F.col("doc_id").alias("_copy")).distinct()
    # As a table the list has a known size: a short one is broadcast, and the documents stay where they are.
    copies = written(copies, f"{shared_folder(spark, 'copies')}/ids")
    return docs.join(copies, docs["doc_id"] == copies["_copy"], "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and what the contract of the BPE query asks for."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digests(bpe.decode(bpe.encode(docs, path), path), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("token_ids", token_ids),
]

# Merging byte pairs is no SQL; tests/llm compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each result written before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{k}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
