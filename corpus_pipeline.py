"""Corpus pipeline: quality rules, n-gram Jaccard join, secret scan, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. Its result is to be written as Parquet and
reread as the next one's docs. Null, empty and very long texts, null ids and sources, repeated rows and further columns of any
name pass every stage: a null or empty text fails the base rule and goes in the first; a repeated row is a copy, of which the
second keeps one; ties between copies go to the smallest id, a null id last; an empty table stays empty. Tokenising can't
be said in SQL, so there is no twin; tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioframe.llm import mixing, ngram_join, packing, quality_rules, secret_scan
from folioframe.llm.common import stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality_rules.filter_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.keep_one(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; documents stay."""
    import public_tokenizers

    words = secret_scan.dictionary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return secret_scan.redact(docs, secret_scan.train(spark, words=words))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their targets: documents repeat, or stay in part."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become pieces of windows of at most 1024 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("secret_scan", secret_stage),
    ("source_mixing", mixing_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
