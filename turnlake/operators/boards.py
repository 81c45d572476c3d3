"""Ranked boards, insights, timelines and dashboard figures over the rollups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnlake.operators.rollups import FLAGS

ADHOC_ROWS = 50


def _checked(value, allowed, what: str):
    if value not in allowed:
        raise ValueError(f"{what} must be one of {', '.join(map(str, allowed))}, not {value!r}")
    return value


def _checked_limit(limit: int, most: int) -> int:
    if not 1 <= limit <= most:
        raise ValueError(f"limit must be between 1 and {most}, not {limit}")
    return limit


def _sort(column: str, order: str) -> Column:
    _checked(order, ("asc", "desc"), "order")
    return F.desc_nulls_first(column) if order == "desc" else F.asc_nulls_last(column)


def _ranked(page: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Rank 1..n of an already limited page: the unpartitioned window sees at most `limit` rows."""
    return page.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def percent(value: Column) -> Column:
    return F.round(value * 100, 2)


def _zero(column: str) -> Column:
    return F.coalesce(column, F.lit(0.0))


def model_board(rollup: DataFrame, sort_by: str = "avg_success", order: str = "desc", limit: int = 10) -> DataFrame:
    _checked(sort_by, ("avg_success", "attempts", "median_success"), "sort_by")
    by = [_sort(sort_by, order), F.asc("model_name")]
    page = rollup.orderBy(*by).limit(_checked_limit(limit, 100))
    return _ranked(page, by).select(
        "model_name",
        "attempts",
        _zero("avg_success").alias("avg_success"),
        _zero("median_success").alias("median_success"),
        "rank",
        percent(_zero("avg_success")).alias("success_rate_pct"),
    )


def difficulty(rate: Column) -> Column:
    return F.when(rate >= 0.75, "easy").when(rate >= 0.5, "medium").otherwise("hard")


def language_board(rollup: DataFrame, sort_by: str = "success_rate", order: str = "desc", limit: int = 20) -> DataFrame:
    _checked(sort_by, ("success_rate", "prompts", "median_success"), "sort_by")
    by = [_sort(sort_by, order), F.asc("programming_lang")]
    page = rollup.orderBy(*by).limit(_checked_limit(limit, 200))
    return _ranked(page, by, "position").select(
        F.col("programming_lang").alias("programming_language"),
        F.col("prompts").alias("total_prompts"),
        _zero("success_rate").alias("success_rate"),
        _zero("median_success").alias("median_success"),
        difficulty(_zero("success_rate")).alias("difficulty_level"),
        "position",
    )


def combination_id() -> Column:
    parts = [("contains_examples", "EX", "NE"), ("contains_code", "CO", "NC"), ("contains_constraints", "CT", "NT")]
    return F.concat_ws("_", *[F.when(F.col(flag), yes).otherwise(no) for flag, yes, no in parts])


def combination_label() -> Column:
    named = [F.when(F.col(flag), flag.removeprefix("contains_")) for flag in FLAGS]
    return F.coalesce(F.nullif(F.concat_ws(" + ", *named), F.lit("")), F.lit("no features"))


def active_features() -> Column:
    return sum((F.col(flag).cast("int") for flag in FLAGS), F.lit(0))


def feature_board(
    rollup: DataFrame, min_samples: int = 10, sort_by: str = "avg_success", order: str = "desc", limit: int = 8
) -> DataFrame:
    _checked(sort_by, ("avg_success", "cnt", "median_success"), "sort_by")
    by = [_sort(sort_by, order), F.desc("cnt"), *[F.asc(flag) for flag in FLAGS]]
    page = rollup.where(F.col("cnt") >= min_samples).orderBy(*by).limit(_checked_limit(limit, 20))
    active = active_features()
    return _ranked(page, by, "position").select(
        *FLAGS,
        F.col("cnt").alias("sample_count"),
        _zero("avg_success").alias("avg_success"),
        _zero("median_success").alias("median_success"),
        combination_id().alias("feature_combination_id"),
        combination_label().alias("combination"),
        F.when(active == 0, "BASELINE").otherwise(F.concat(active.cast("string"), F.lit(" FEAT"))).alias("active_label"),
        "position",
    )


def feature_insights(board: DataFrame) -> DataFrame:
    """Best and worst combination of a feature board; NULLs and low confidence for an empty one."""
    best = F.max_by(F.struct("combination", "sample_count"), F.struct("avg_success", -F.col("position")))
    worst = F.min_by("combination", F.struct("avg_success", -F.col("position")))
    return board.agg(best.alias("best"), worst.alias("worst_combination")).select(
        F.col("best.combination").alias("best_combination"),
        "worst_combination",
        F.when(F.col("best.sample_count") >= 100, "medium").otherwise("low").alias("confidence"),
    )


def template_board(
    rollup: DataFrame, min_uses: int = 5, sort_by: str = "avg_success", order: str = "desc", limit: int = 10
) -> DataFrame:
    _checked(sort_by, ("avg_success", "uses", "median_success"), "sort_by")
    by = [_sort(sort_by, order), F.desc("uses"), F.asc("prompt_hash")]
    page = rollup.where(F.col("uses") >= min_uses).orderBy(*by).limit(_checked_limit(limit, 100))
    text = F.coalesce("prompt_text", F.lit(""))
    return _ranked(page, by).select(
        "prompt_hash",
        F.substring(text, 1, 160).alias("prompt_preview"),
        (F.length(text) > 0).alias("full_prompt_available"),
        F.col("uses").alias("usage_count"),
        _zero("avg_success").alias("avg_success"),
        _zero("median_success").alias("median_success"),
        percent(_zero("avg_success")).alias("success_rate_pct"),
        "rank",
    )


def template_count(rollup: DataFrame, min_uses: int = 5) -> DataFrame:
    return rollup.where(F.col("uses") >= min_uses).agg(F.count("*").alias("total_templates"))


def timeline(
    rollup: DataFrame,
    as_of: dt.date | None = None,
    days: int = 30,
    start: dt.date | None = None,
    end: dt.date | None = None,
    model: str | None = None,
) -> DataFrame:
    """Daily rows of the last `days` before `as_of` (today), or of an explicit range, for one model or all."""
    if (start is None) != (end is None):
        raise ValueError("start and end must be given together")
    if not 1 <= days <= 365:
        raise ValueError(f"days must be between 1 and 365, not {days}")
    if start is not None:
        kept = rollup.where(F.col("day").between(F.lit(start), F.lit(end)))
    else:
        kept = rollup.where(F.col("day") >= F.lit((as_of or dt.date.today()) - dt.timedelta(days=days)))
    return kept if model is None else kept.where(F.col("model_name") == model)


def timeline_nested(rows: DataFrame) -> DataFrame:
    """One row per day with its models in name order. Input are rollup rows: a day has one per model."""
    point = F.struct(
        "model_name",
        "attempts",
        _zero("avg_success").alias("avg_success"),
        _zero("median_success").alias("median_success"),
    )
    return rows.groupBy("day").agg(F.array_sort(F.collect_list(point)).alias("series"))


def timeline_scope(rows: DataFrame) -> DataFrame:
    """One row: the models in name order and the first and last day."""
    per_model = rows.groupBy("model_name").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    return per_model.agg(
        F.array_sort(F.collect_list("model_name")).alias("models"),
        F.min("first").alias("start"),
        F.max("last").alias("end"),
    )


def timeline_pivot(rows: DataFrame, models: list[str]) -> DataFrame:
    """Day by model in percent. The models are given, so no extra job looks for them."""
    value = F.first(F.coalesce("avg_success", F.lit(0.0)) * 100)
    return rows.groupBy("day").pivot("model_name", models).agg(value)


def latest_days(rollup: DataFrame, limit: int = 30) -> DataFrame:
    return rollup.orderBy(F.desc("day"), "model_name").limit(limit)


def efficiency_board(efficiency: DataFrame, limit: int | None = None) -> DataFrame:
    """Best score first, then lowest latency. Without `limit` the whole table keeps its NULL scores last; the
    dashboard's short list (12) counts a missing score as 0 and a missing latency as infinite.
    """
    if limit is None:
        return efficiency.orderBy(
            F.desc_nulls_last("avg_success_score"), F.asc_nulls_last("avg_latency"), F.asc("model_name")
        )
    by = [F.desc(_zero("avg_success_score")), F.asc_nulls_last("avg_latency"), F.asc("model_name")]
    return _ranked(efficiency.orderBy(*by).limit(limit), by, "position")


def dashboard_kpis(models: DataFrame, languages: DataFrame, features: DataFrame) -> DataFrame:
    """One row of headline figures over the three boards; the system rate is the plain mean of the model rates."""
    first_best = F.struct("success_rate_pct", -F.col("rank"))
    of_models = models.agg(
        F.coalesce(F.sum("attempts"), F.lit(0)).alias("total_attempts"),
        F.count("*").alias("tracked_models"),
        F.round(F.coalesce(F.avg("success_rate_pct"), F.lit(0.0)), 1).alias("system_success_pct"),
        F.max_by("model_name", first_best).alias("top_model"),
    )
    of_languages = languages.agg(
        F.min_by("programming_language", F.struct("success_rate", "position")).alias("hardest_language")
    )
    of_features = features.agg(F.count("*").alias("feature_combos"))
    one = F.lit(1).alias("one")
    joined = of_models.select("*", one).join(of_languages.select("*", one), "one").join(of_features.select("*", one), "one")
    return joined.drop("one")


def adhoc(spark: SparkSession, tables: dict[str, DataFrame], query: str) -> DataFrame:
    """A read-only query over the given tables; the first 50 rows."""
    if not query.strip().upper().startswith("SELECT"):
        raise ValueError("only SELECT queries are allowed")
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return spark.sql(query).limit(ADHOC_ROWS)
