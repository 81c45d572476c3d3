"""A corpus run from raw documents to token files: every stage works on all that the stage before kept.

Documents may have null or repeated ids, null or empty texts of any length, any further columns, or be none at all. A null
text counts as empty; without two grades among the ratings no document is rejected; of documents whose fingerprints are
linked (texts without words among them) one row stays, by the smallest id, null ids last, then by text; texts without words
are never contaminated and take no words of the mixture. Rows that are equal in id and text are one document to
the near-duplicate stage, so every document left is a row of its own from there on. Each stage but the last keeps the columns
of the documents; the last gives a row for each document of the mixture, repeats included.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from turnlake.llm import decontamination, mixing, quality_model, simhash, token_files
from turnlake.session import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it is fitted on the rated ones among the documents."""
    model = quality_model.trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_model.selected(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their SimHash fingerprints, the one with the smallest id stays."""
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a benchmark contaminates go."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them, in shuffled shards."""
    return mixing.mixed(docs, mixing.plan(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixture; the result is what they hold of each row."""
    return token_files.written(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("source_mixture", mix),
    ("token_files", tokens),
]

#: The classifier, the fingerprints and the tokenizer can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again before the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
