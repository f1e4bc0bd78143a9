"""The operators on the given tables: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantlens.llm import (
    conversation_repair,
    decontamination,
    language_id,
    license_scan,
    line_dedup,
    ngram_jaccard,
    piece_codec,
    prefix_trie,
    secret_scan,
    source_mix,
    substring_dedup,
    token_shards,
    topk_search,
)
from tenantlens.llm.common import table
from tenantlens.session import scratch_dir

VOCABULARY = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    return source_mix.mix(docs, labels)


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontamination.leaks(docs, items, n=5, percent=80)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"), owner="source")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(spark, table(spark, sf_dir, "documents"))


def encoded(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents written as token shards in the shared folder, and read from them."""
    import public_tokenizers

    path = scratch_dir(spark, "token-shards")
    token_shards.write_shards(docs, public_tokenizers.path(VOCABULARY), path, end_id=2)
    return token_shards.read_documents(spark, path)


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.jaccard_classes(table(spark, sf_dir, "documents"), n=5, percent=80)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.find_licenses(table(spark, sf_dir, "documents"), least=0.8)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_lines(table(spark, sf_dir, "documents"), least_refs=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.report(conversation_repair.repair(rows))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    coded = piece_codec.coded(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie.trie(prefix_trie.paths(table(spark, sf_dir, "conversations")))
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_source_mix": op2_source_mix,
    "op3_topk_search": op3_topk_search,
    "op4_decontamination": op4_decontamination,
    "op5_secret_scan": op5_secret_scan,
    "op6_language_id": op6_language_id,
    "op7_token_shards": op7_token_shards,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_license_scan": op9_license_scan,
    "op10_line_dedup": op10_line_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_prefix_trie": op13_prefix_trie,
}
