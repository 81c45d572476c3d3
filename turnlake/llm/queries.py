"""The registered queries of the subpackage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from turnlake.llm import (
    alignment,
    bundles,
    decontamination,
    exact_dedup,
    licenses,
    mixing,
    prefix_trie,
    quality_model,
    secret_scan,
    simhash,
    suffix_tree,
    token_counts,
    token_files,
)
from turnlake.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, folder, "documents"), PIECE_VOCABULARY)


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scanned(_table(spark, folder, "documents"))


def op4_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def op5_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(mixing.plan(_table(spark, folder, "documents")))


def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scanned(_table(spark, folder, "documents"))


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.written(_table(spark, folder, "documents"), WORD_VOCABULARY)


def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return quality_model.rated(docs, quality_model.trained(docs, _table(spark, folder, "labels")))


def op9_suffix_tree_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return suffix_tree.scores(docs, suffix_tree.trained(docs, tree=False))


def op10_exact_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.deduplicated(_table(spark, folder, "documents"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_nodes(_table(spark, folder, "conversations"))


def op12_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.link_counts(_table(spark, folder, "documents"), BYTE_VOCABULARY, PIECE_VOCABULARY)


def op13_warc_bundles(spark: SparkSession, folder: str) -> DataFrame:
    return bundles.archived(_table(spark, folder, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_benchmark_decontamination, op2_token_counts, op3_license_scan, op4_simhash_near_duplicates, op5_mixture, op6_secret_scan, op7_token_files,
        op8_quality_classifier, op9_suffix_tree_scores, op10_exact_duplicates, op11_prefix_trie, op12_tokenizer_alignment, op13_warc_bundles,
    )
}
