"""The prompt feature bundle and the record assembly around it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnlake.functions import text as X
from turnlake.functions.tasks import task_type
from turnlake.functions.times import batch_name, instant
from turnlake.operators.language import Profile

FEATURES = (
    "prompt_hash", "prompt_length", "length", "token_estimate", "token_count", "prompt_type", "type",
    "contains_code", "contains_examples", "contains_constraints", "example_count", "constraint_count",
    "language", "complexity_score", "instruction_density", "response_tokens", "tokens", "programming_lang",
)


def with_prompt_features(df: DataFrame, profile: Profile | None = None) -> DataFrame:
    """Add the 18 feature columns. Reads prompt_text and, when present, response_text, language and prompt_type; a profile
    tells the language of unlabelled texts.

    One row in, one row out, no shuffle: all of it is a projection over the scan.
    """
    return _featured(df, profile).drop("_marks")


def _featured(df: DataFrame, profile: Profile | None) -> DataFrame:
    """The features, and the prompt's marks as `_marks`."""
    for optional in ("response_text", "language", "prompt_type"):
        if optional not in df.columns:
            df = df.withColumn(optional, F.lit(None).cast("string"))
    prompt, response = F.col("prompt_text"), F.col("response_text")
    base = df.withColumns({"prompt_text": X.strip(F.coalesce(prompt, F.lit(""))), "response_text": X.strip(response)})
    base = base.withColumns({"_norm": X.normalize(prompt), "_response_norm": X.normalize(response), "_marks": X.marks(prompt)})
    found = F.col("_marks")
    counted = base.withColumns(
        {
            "example_count": X.count_marks(found, X.EXAMPLES),
            "constraint_count": X.count_marks(found, X.CONSTRAINTS),
            "token_estimate": X.token_estimate(F.col("_norm")),
            "_response_tokens": X.token_estimate(F.col("_response_norm")),
            "_words": X.word_count(F.col("_norm")),
            "_verbs": X.count_marks(found, X.VERBS),
            "prompt_length": F.length(prompt),
            "prompt_type": X.prompt_type(prompt, F.col("prompt_type"), found),
        }
    )
    tokens, constraints, examples = F.col("token_estimate"), F.col("constraint_count"), F.col("example_count")
    return counted.withColumns(
        {
            "prompt_hash": X.sha256(F.col("_norm")),
            "length": F.col("prompt_length"),
            "token_count": tokens,
            "type": F.col("prompt_type"),
            "contains_code": X.has_code(prompt) | X.has_code(response),
            "contains_examples": examples > 0,
            "contains_constraints": constraints > 0,
            "language": X.spoken_language("prompt_text", "language", profile.detected_sql("prompt_text") if profile else X.detected_sql("_norm")),
            "complexity_score": F.round(F.lit(0.4) * tokens + F.lit(0.3) * constraints + F.lit(0.3) * examples, 4),
            "instruction_density": F.round(F.col("_verbs") / F.greatest(F.col("_words"), F.lit(1)), 4),
            "response_tokens": F.nullif(F.col("_response_tokens"), F.lit(0)),
            "tokens": tokens + F.col("_response_tokens"),
            "programming_lang": X.programming_language("prompt_text", "response_text"),
        }
    ).drop("_norm", "_response_norm", "_response_tokens", "_words", "_verbs")


def with_lineage(
    df: DataFrame, run_ts: dt.datetime, dataset: str, method: str | None = None, version: str | None = None
) -> DataFrame:
    """Source name, collection method, version, ingest time and batch id."""
    started = instant(run_ts)
    return df.withColumns(
        {
            "dataset_name": F.lit(dataset),
            "collection_method": F.lit(method or "huggingface_disk"),
            "version": F.lit(version).cast("string"),
            "ingest_timestamp": started,
            "batch_id": batch_name(started),
        }
    )


def prompt_records(events: DataFrame, profile: Profile | None = None) -> DataFrame:
    """Prompt events to records: session id, features, task type."""
    with_session = events.withColumn("session_id", X.sha256(F.col("conversation_id")))
    featured = _featured(with_session, profile)
    return featured.withColumn("task_type", task_type(F.col("task_type"), F.col("prompt_text"), F.col("_marks"))).drop("_marks")


def comparison_records(events: DataFrame, profile: Profile | None = None) -> DataFrame:
    """Comparison events to records: features only, no task type."""
    return with_prompt_features(events, profile)
