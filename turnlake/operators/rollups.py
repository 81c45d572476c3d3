"""The five rollups and the model-efficiency table over the star.

Every rollup first counts facts per (dimension key, score). The dimension joins and the medians then work on those
counts, so a key that holds a third of the facts is a handful of rows by the time it is shuffled or joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnlake.operators.ordered import score_counts, score_summary

FLAGS = ["contains_examples", "contains_code", "contains_constraints"]


def _named(summary: DataFrame, keys: list[str], count: str, mean: str = "avg_success") -> DataFrame:
    return summary.select(
        *keys, F.col("n").alias(count), F.col("mean").alias(mean), F.col("median").alias("median_success")
    )


def daily_counts(facts: DataFrame) -> DataFrame:
    """Facts per (day, model_key, score): counts that add up over loads.

    A time key is the microsecond itself, so the day needs no join with the (fact-sized) time dimension.
    """
    dated = facts.where(F.col("time_key").isNotNull()).withColumn("day", F.to_date(F.timestamp_micros("time_key")))
    return score_counts(dated, ["day", "model_key"])


def daily_from_counts(counts: DataFrame, models: DataFrame) -> DataFrame:
    """(day, model) with `unknown` for facts without a model, from `daily_counts`."""
    named = counts.join(models.select("model_key", "model_name"), "model_key", "left")
    named = named.withColumn("model_name", F.coalesce("model_name", F.lit("unknown")))
    keys = ["day", "model_name"]
    return _named(score_summary(named, keys), keys, "attempts")


def daily_model_success(facts: DataFrame, models: DataFrame) -> DataFrame:
    """(day, model) with `unknown` for facts without a model."""
    return daily_from_counts(daily_counts(facts), models)


def arena_model_performance(facts: DataFrame, models: DataFrame, sources: DataFrame) -> DataFrame:
    """Models over the arena sources only."""
    arena = sources.where(F.col("dataset_name").ilike("%arena%")).select("source_key")
    counts = score_counts(facts, ["model_key", "source_key"]).join(arena, "source_key")
    named = counts.join(models.select("model_key", "model_name"), "model_key")
    return _named(score_summary(named, ["model_name"]), ["model_name"], "attempts")


def language_performance(facts: DataFrame, tasks: DataFrame) -> DataFrame:
    """Programming languages of the tasks."""
    known = tasks.where(F.col("programming_lang").isNotNull()).select("task_key", "programming_lang")
    counts = score_counts(facts, ["task_key"]).join(known, "task_key")
    return _named(score_summary(counts, ["programming_lang"]), ["programming_lang"], "prompts", "success_rate")


def feature_impact(facts: DataFrame, prompts: DataFrame) -> DataFrame:
    """The eight combinations of the three prompt flags."""
    counts = score_counts(facts, ["prompt_key"]).join(prompts.select("prompt_key", *FLAGS), "prompt_key")
    return _named(score_summary(counts, FLAGS), FLAGS, "cnt")


def template_performance(facts: DataFrame, prompts: DataFrame) -> DataFrame:
    """Prompts by use. Grouped by the narrow key; the text joins the finished groups."""
    per_prompt = score_summary(score_counts(facts, ["prompt_key"]), ["prompt_key"])
    rows = per_prompt.join(prompts.select("prompt_key", "prompt_hash", "prompt_text"), "prompt_key")
    return _named(rows, ["prompt_hash", "prompt_text"], "uses")


def model_efficiency(facts: DataFrame, models: DataFrame) -> DataFrame:
    """Latency, tokens and score per model; facts without a model drop out.

    `avg_tokens` adds the response tokens to `tokens`, which already holds them; `avg_tokens_once` does not.
    """
    per_model = facts.groupBy("model_key").agg(
        F.avg("latency").alias("avg_latency"),
        F.avg(F.col("tokens") + F.coalesce("response_tokens", F.lit(0))).alias("avg_tokens"),
        F.avg("tokens").alias("avg_tokens_once"),
        F.avg("success_score").alias("avg_success_score"),
        F.count("*").alias("execution_count"),
        F.count("latency").alias("latency_samples"),
        F.count("success_score").alias("success_samples"),
    )
    return models.select("model_key", "model_name").join(per_model, "model_key").drop("model_key")


def all_rollups(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The five rollups by name."""
    facts = tables["fact_promptexecution"]
    return {
        "daily_model_success": daily_model_success(facts, tables["dim_model"]),
        "model_performance_arena": arena_model_performance(facts, tables["dim_model"], tables["dim_source"]),
        "language_performance": language_performance(facts, tables["dim_task"]),
        "prompt_feature_impact": feature_impact(facts, tables["dim_prompt"]),
        "top_prompt_templates": template_performance(facts, tables["dim_prompt"]),
    }
