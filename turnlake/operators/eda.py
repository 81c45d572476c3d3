"""Exploratory summaries."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnlake.operators.ordered import exact_quantiles


EXTRACT = (
    "prompt_length", "token_estimate", "contains_code", "contains_examples", "contains_constraints", "language",
    "complexity_score", "instruction_density", "success_score", "tokens", "response_tokens",
)


def eda_extract(facts: DataFrame, prompts: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Scored facts with their prompt's features and the outcome `is_successful`, without latency; rows without
    score, complexity or length are left out.
    """
    own = [name for name in prompts.columns if name not in facts.columns or name == "prompt_key"]
    joined = facts.where(F.col("success_score").isNotNull()).join(prompts.select(*own), "prompt_key")
    outcome = (F.col("success_score") >= 0.5).cast("int").alias("is_successful")
    rows = joined.select(*keep, *EXTRACT, outcome)
    return rows.dropna(subset=["success_score", "complexity_score", "prompt_length"])


def language_success(df: DataFrame, more_than: int = 50) -> DataFrame:
    """Mean score and size per language, rare languages left out."""
    per_language = df.groupBy("language").agg(F.avg("success_score").alias("avg_success"), F.count("*").alias("sample_size"))
    return per_language.where(F.col("sample_size") > more_than)


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation over complete rows as (x, y, r), both triangles, from one aggregation."""
    complete = df.select(*columns).dropna()
    pairs = list(combinations_with_replacement(columns, 2))
    row = complete.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"r{i}").alias("r")))
    return row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def score_density(df: DataFrame, group: str, score: str = "success_score", width: float = 0.05) -> DataFrame:
    """Exact binned density of the score per group: rows per bin and their share per unit of score."""
    bins = (
        df.where(F.col(score).isNotNull())
        .groupBy(group, F.floor(F.col(score) / width).alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    sizes = bins.groupBy(group).agg(F.sum("n").alias("group_n"))
    return bins.join(sizes, group).select(
        group, "bin", "n", (F.col("n") / F.col("group_n") / width).alias("density")
    )


def target_summary(df: DataFrame, target: str = "success_rate") -> DataFrame:
    """Mean, sample deviation, min, max, median and missing values of the target. The bins in which the median is
    looked for follow the data, so a column of any range is ordered in parallel.
    """
    shape = df.agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col(target).isNull()).alias("missing"),
        F.avg(target).alias("mean"),
        F.stddev_samp(target).alias("std"),
        F.min(target).alias("min"),
        F.max(target).alias("max"),
    )
    median = exact_quantiles(df, {target: [0.5]})[target][0]
    return shape.withColumn("median", F.lit(median).cast("double"))


def missing_values(df: DataFrame) -> DataFrame:
    """NULLs per column as (column, missing)."""
    row = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])
    cells = [F.struct(F.lit(name).alias("column"), F.col(name).alias("missing")) for name in df.columns]
    return row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
