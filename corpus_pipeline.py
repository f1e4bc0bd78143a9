"""Corpus pipeline: documents to token shards, in five stages over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tenantlens.llm import decontamination, language_id, ngram_jaccard, queries, source_mix
from tenantlens.llm.common import on_workers, table
from tenantlens.session import scratch_dir

LEAST_SCORE = 0.1  # of a text in its language: less is no text in any language learned


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters, or of no language learned from the same documents, go."""
    on_workers(spark)
    return language_id.recognized(docs, language_id.learn(docs), LEAST_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id stays of each component of 0.8 similar ones."""
    on_workers(spark)
    return ngram_jaccard.one_of_each(docs, n=5, percent=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    on_workers(spark)
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"), n=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    on_workers(spark)
    return source_mix.mixed(docs, table(spark, sf_dir, "labels"))


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 as read from the shards written."""
    on_workers(spark)
    return queries.encoded(spark, docs)


STAGES = [
    ("language_id", languages),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("source_mix", mixture),
    ("token_shards", token_shards),
]

ORACLE_SQL = None  # SQL can't express the language model; tests/llm hold it against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order on ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
