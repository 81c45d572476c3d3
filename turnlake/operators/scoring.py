"""Bulk prompt scoring: scoring features, the heuristic score, what-if variants, model and cluster scores."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnlake.functions.text import normalize, word_count

# The three text edits of the what-if analysis.
VARIANTS = (
    ("Add explicit code blocks", "```", "\n\n```python\n# Example Code\n```"),
    ("Add context or examples", "example", " Here is an example: "),
    ("Add explicit constraints", "must", " You must only output valid JSON."),
)
# Display names of the clusters.
CLUSTER_NAMES = {0: "Simple & Short", 1: "Complex & Detailed", 2: "Code Snippets", 3: "Example-Rich"}
# Prompts that tell a constant model from a working one.
PROBES = (
    "Explain the following concept in 3 bullet points.",
    "You must output valid JSON with keys: steps, assumptions, result.",
    "Here is an example:\nInput: 2\nOutput: 4\nNow generalize.",
    "```python\nprint('hello')\n```\nExplain what this does.",
)


def _count(text: Column, part: str) -> Column:
    """Non-overlapping occurrences of a plain substring."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("int")


def scoring_features(df: DataFrame, text: str = "prompt_text") -> DataFrame:
    """The 24 scoring columns. Their definitions differ from the training ones on purpose: this is what the scorer
    feeds its models.
    """
    raw, lowered = F.col(text), F.lower(text)
    code = F.contains(raw, F.lit("```"))
    examples = F.contains(lowered, F.lit("example")) | F.contains(lowered, F.lit("e.g."))
    constraints = F.contains(lowered, F.lit("must")) | F.contains(lowered, F.lit("only"))
    roleplay = F.contains(lowered, F.lit("act as"))
    sized = df.withColumns(
        {
            "prompt_length": F.length(raw),
            "prompt_word_count": word_count(normalize(raw)),
            "code_blocks": _count(raw, "```"),
        }
    )
    solid = F.length(F.replace(raw, F.lit(" "), F.lit("")))
    with_average = sized.withColumn("avg_word_length", solid / F.greatest(F.col("prompt_word_count"), F.lit(1)))
    flags = {"contains_code": code, "contains_examples": examples, "contains_constraints": constraints}
    columns = {
        "question_marks": _count(raw, "?"),
        "list_items": _count(raw, "\n-") + _count(raw, "\n*"),
        "capital_ratio": F.regexp_count(raw, F.lit(r"\p{Lu}")) / F.greatest(F.col("prompt_length"), F.lit(1)),
        "instruction_density": F.lit(0.5),
        "complexity_score": F.col("avg_word_length") + F.col("code_blocks") * 2,
        "tokens_used": F.col("prompt_word_count") * F.lit(1.3),
        "latency_ms": F.lit(100.0),
        "attempt_count": F.lit(1),
        "language_unknown": F.lit(1),
        "prompt_type_roleplay": roleplay.cast("int"),
        "prompt_type_standard": (~roleplay).cast("int"),
    }
    for name, flag in flags.items():
        columns |= {name: flag.cast("int"), f"{name}_False": (~flag).cast("int"), f"{name}_True": flag.cast("int")}
    return with_average.withColumns(columns)


# The columns the scorer feeds its models, in their order.
SCORING_COLUMNS = (
    "prompt_length", "instruction_density", "complexity_score", "tokens_used", "latency_ms", "attempt_count",
    "prompt_word_count", "avg_word_length", "question_marks", "code_blocks", "list_items", "capital_ratio",
    "contains_code", "contains_examples", "contains_constraints", "language_unknown", "prompt_type_roleplay",
    "prompt_type_standard", "contains_code_False", "contains_code_True", "contains_examples_False",
    "contains_examples_True", "contains_constraints_False", "contains_constraints_True",
)


def clamp(value: Column) -> Column:
    """Into [0, 1]; not-a-number and infinities become 0."""
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    return F.when(finite, F.greatest(F.least(value, F.lit(1.0)), F.lit(0.0))).otherwise(0.0)


def heuristic_score(
    length: Column | None = None,
    code: Column | None = None,
    examples: Column | None = None,
    constraints: Column | None = None,
    density: Column | None = None,
    complexity: Column | None = None,
) -> Column:
    """Success score from the scoring features, in [0, 0.95]; any feature can be replaced."""

    def feature(given: Column | None, name: str) -> Column:
        return F.coalesce(F.col(name) if given is None else given, F.lit(0)).cast("double")

    size = feature(length, "prompt_length")
    score = (
        F.lit(0.15)
        + 0.20 * feature(examples, "contains_examples")
        + 0.20 * feature(constraints, "contains_constraints")
        + 0.15 * feature(code, "contains_code")
        + F.when(size < 40, -0.10).when(size > 1200, -0.05).otherwise(0.05)
        + 0.10 * clamp(feature(density, "instruction_density"))
        + 0.10 * clamp(feature(complexity, "complexity_score") / 20)
    )
    return clamp(F.least(score, F.lit(0.95)))


def model_score(scored: DataFrame, models: Sequence[Transformer]) -> DataFrame:
    """Add `model_score`: the clamped mean of the models' predictions; NULL without models."""
    if not models:
        return scored.withColumn("model_score", F.lit(None).cast("double"))
    for i, model in enumerate(models):
        before = scored.columns
        scored = model.transform(scored).select(*before, F.col("prediction").alias(f"_prediction_{i}"))
    names = [f"_prediction_{i}" for i in range(len(models))]
    mean = reduce(Column.__add__, [F.col(name) for name in names]) / len(names)
    return scored.withColumn("model_score", clamp(mean)).drop(*names)


def is_degenerate(probes: DataFrame, models: Sequence[Transformer]) -> bool:
    """True without models, or when they give every probe prompt the same score."""
    if not models:
        return True
    rounded = model_score(scoring_features(probes), models).select(F.round("model_score", 6).alias("s"))
    spread = rounded.agg((F.max("s") - F.min("s")).alias("spread")).first()["spread"]
    return spread is None or spread < 1e-6


def usable_models(spark: SparkSession, models: Sequence[Transformer]) -> list[Transformer]:
    """The models, or none (the heuristic then scores) if they cannot tell the probe prompts apart."""
    probes = spark.createDataFrame([(text,) for text in PROBES], "prompt_text string")
    return [] if is_degenerate(probes, models) else list(models)


def success_scores(prompts: DataFrame, models: Sequence[Transformer] = ()) -> DataFrame:
    """Scoring features and `score`: the models' where usable, else the heuristic."""
    scored = model_score(scoring_features(prompts), models)
    return scored.withColumn("score", F.coalesce("model_score", heuristic_score())).drop("model_score")


def what_if_text(prompts: DataFrame, key: str, models: Sequence[Transformer] = ()) -> DataFrame:
    """(key, variant, baseline, predicted_score, rank) for every text edit that scores above the prompt itself.

    Each prompt becomes at most four rows in place (itself and three edits), scored in one pass; comparing them needs
    a shuffle of narrow rows only.
    """
    text, lowered = F.col("prompt_text"), F.lower("prompt_text")
    edits = [F.struct(F.lit("").alias("variant"), text.alias("prompt_text"), F.lit(0).alias("place"))]
    for place, (name, marker, addition) in enumerate(VARIANTS, start=1):
        source = text if marker == "```" else lowered
        edit = F.struct(
            F.lit(name).alias("variant"),
            F.concat(text, F.lit(addition)).alias("prompt_text"),
            F.lit(place).alias("place"),
        )
        edits.append(F.when(~F.contains(source, F.lit(marker)), edit))
    rows = prompts.select(key, F.explode(F.array_compact(F.array(*edits))).alias("edit")).select(key, "edit.*")
    scored = success_scores(rows, models).select(key, "variant", "place", "score")
    per_prompt = Window.partitionBy(key)
    compared = scored.withColumn("baseline", F.max(F.when(F.col("place") == 0, F.col("score"))).over(per_prompt))
    better = compared.where((F.col("place") > 0) & (F.col("score") > F.col("baseline")))
    ranked = better.withColumn("rank", F.row_number().over(per_prompt.orderBy(F.round(F.col("score"), 3).desc(), "place")))
    return ranked.select(
        key,
        "variant",
        F.round("baseline", 3).alias("baseline_score"),
        F.round("score", 3).alias("predicted_score"),
        "rank",
    )


def what_if_features(features: DataFrame, key: str) -> DataFrame:
    """The same by feature edit: sets one flag; the code variant also adds two code marks (four complexity).

    All three variants of a row are compared inside the row, so nothing is shuffled.
    """
    one = F.lit(1)
    projected = (
        ("contains_code", VARIANTS[0][0], heuristic_score(code=one, complexity=F.col("complexity_score") + 4)),
        ("contains_examples", VARIANTS[1][0], heuristic_score(examples=one)),
        ("contains_constraints", VARIANTS[2][0], heuristic_score(constraints=one)),
    )
    scored = features.withColumn("baseline", heuristic_score())
    candidates = [
        F.when(
            (F.col(flag) == 0) & (score > F.col("baseline")),
            F.struct((-score).alias("order"), F.lit(i).alias("place"), F.lit(name).alias("variant"), score.alias("score")),
        )
        for i, (flag, name, score) in enumerate(projected)
    ]
    kept = F.array_sort(F.array_compact(F.array(*candidates)))
    return scored.select(key, "baseline", F.posexplode(kept).alias("pos", "c")).select(
        key,
        F.col("c.variant").alias("variant"),
        F.col("baseline").alias("baseline_score"),
        F.col("c.score").alias("predicted_score"),
        (F.col("pos") + 1).alias("rank"),
    )


def confidence_level(probability: Column) -> Column:
    return F.when(probability > 0.7, "high").when(probability > 0.4, "medium").otherwise("low")


def cluster_name(cluster: Column) -> Column:
    chain = reduce(lambda c, item: c.when(cluster == item[0], item[1]), CLUSTER_NAMES.items(), F.when(F.lit(False), ""))
    return chain.otherwise("Unknown")


def with_request_defaults(df: DataFrame) -> DataFrame:
    """Features of a scoring request: missing token counts count as 100, missing (or zero) scores as 0.5."""

    def default(name: str, value: float) -> Column:
        return F.coalesce(F.nullif(F.col(name).cast("double"), F.lit(0.0)), F.lit(value))

    return df.withColumns(
        {
            "token_estimate": default("token_count", 100.0),
            "tokens_used": default("token_count", 100.0),
            "instruction_density": default("instruction_density", 0.5),
            "complexity_score": default("complexity_score", 0.5),
            "contains_code": F.coalesce(F.col("contains_code").cast("int"), F.lit(0)),
            "contains_examples": F.coalesce(F.col("contains_examples").cast("int"), F.lit(0)),
            "contains_constraints": F.coalesce(F.col("contains_constraints").cast("int"), F.lit(0)),
            "latency_ms": F.lit(100.0),
            "attempt_count": F.lit(1),
        }
    )


def scored_requests(requests: DataFrame, model: Transformer) -> DataFrame:
    """Success probability and confidence level of given feature rows."""
    predicted = model.transform(with_request_defaults(requests))
    probability = clamp(F.col("prediction"))
    return predicted.select(
        *requests.columns, probability.alias("success_probability"), confidence_level(probability).alias("confidence_level")
    )


def clustered(features: DataFrame, model: Transformer, prediction: str = "cluster") -> DataFrame:
    """Cluster id and display name by a fitted scaler, projection and K-Means pipeline."""
    assigned = model.transform(features)
    return assigned.select(
        *features.columns, F.col(prediction).alias("cluster_id"), cluster_name(F.col(prediction)).alias("cluster_name")
    )
