"""Training set: cleaning, text features, one-hot columns and the feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlake.functions.text import normalize, word_count
from turnlake.operators.ordered import exact_quantiles, with_split
from turnlake.session import stored

# Defaults, imputed columns, categories and numbers of the training set, in their order.
DEFAULT_LATENCY, DEFAULT_TOKENS = 100.0, 10
IMPUTED = ("prompt_length", "token_count", "instruction_density")
CATEGORIES = ("language", "prompt_type", "contains_code", "contains_examples", "contains_constraints")
NUMERIC = (
    "prompt_length", "token_estimate", "instruction_density", "complexity_score", "tokens_used", "latency_ms",
    "attempt_count", "prompt_word_count", "avg_word_length", "question_marks", "code_blocks", "list_items",
    "capital_ratio",
)
MOST_VALUES = 10_000  # columns that one-hot categories may make
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def occurrences(text: Column, characters: str) -> Column:
    """How many characters of the text are among the given ones."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def with_training_features(prompts: DataFrame) -> DataFrame:
    """Word count, mean word length, question marks, code marks, list items and the share of capitals.

    These are functions of the prompt text, so they belong on the prompt dimension, not on every execution.
    """
    text = F.col("prompt_text")
    words = prompts.withColumn("prompt_word_count", word_count(normalize(text)))
    return words.withColumns(
        {
            "prompt_word_count": F.when(text.isNotNull(), F.col("prompt_word_count")),
            "avg_word_length": F.length(F.replace(text, F.lit(" "), F.lit(""))) / (F.col("prompt_word_count") + 1),
            "question_marks": occurrences(text, "?"),
            "code_blocks": F.regexp_count(text, F.lit("```|<code>")),
            "list_items": F.regexp_count(text, F.lit(r"\n-|\n\d+\.")),
            "capital_ratio": occurrences(text, CAPITALS) / (F.length(text) + 1),
        }
    )


def clean_training(extract: DataFrame, key: str = "execution_key") -> DataFrame:
    """Defaults, medians and outliers: latency 100 and 10 tokens when missing, rows without a prompt dropped,
    `unknown` labels, medians for missing numbers, latency up to its 99th percentile, at least one token.

    Repeated keys go once, into a stored table: the thresholds then read two or three of its columns.
    """
    known = stored(extract.dropDuplicates([key]).where(F.col("prompt_word_count").isNotNull()), "training-rows")
    filled = known.withColumns(
        {
            "latency_ms": F.coalesce("latency_ms", F.lit(DEFAULT_LATENCY)),
            "tokens_used": F.coalesce("tokens_used", F.lit(DEFAULT_TOKENS)),
            "model_name": F.coalesce("model_name", F.lit("unknown")),
            "task_type": F.coalesce("task_type", F.lit("unknown")),
            "language": F.coalesce("language", F.lit("unknown")),
            "prompt_type": F.coalesce("prompt_type", F.lit("unknown")),
        }
    )
    gaps = [name for name in IMPUTED if name in filled.columns]
    found = exact_quantiles(filled, {name: [0.5] for name in gaps} | {"latency_ms": [0.99]})
    medians = {name: F.lit(found[name][0] or 0.0).cast(filled.schema[name].dataType) for name in gaps}
    imputed = filled.withColumns({name: F.coalesce(name, value) for name, value in medians.items()})
    [most] = found["latency_ms"]
    in_range = imputed if most is None else imputed.where(F.col("latency_ms") <= most)
    return in_range.where(F.col("tokens_used") > 0)


def category_values(df: DataFrame, names: tuple[str, ...] = CATEGORIES) -> dict[str, list]:
    """Distinct values per category, found in one pass. They become columns, so their number is the width of the feature
    table; more than MOST_VALUES of them (free text, say) are an error, and no more than that reach the driver.
    """
    present = [name for name in names if name in df.columns]
    cells = [F.struct(F.lit(name).alias("name"), F.col(name).cast("string").alias("value")) for name in present]
    pairs = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").where(F.col("value").isNotNull()).distinct()
    found = pairs.limit(MOST_VALUES + 1).collect()
    if len(found) > MOST_VALUES:
        raise ValueError(f"more than {MOST_VALUES} category values among {', '.join(present)}")
    flags = {name for name in present if df.schema[name].dataType.simpleString() == "boolean"}
    values = {name: sorted(row["value"] for row in found if row["name"] == name) for name in present}
    return {name: [v == "true" for v in values[name]] if name in flags else values[name] for name in present}


def one_hot(df: DataFrame, values: dict[str, list]) -> DataFrame:
    """A 0/1 column `name_value` per category value."""
    columns = {
        f"{name}_{value}": F.coalesce((F.col(name) == F.lit(value)).cast("int"), F.lit(0))
        for name, choices in values.items()
        for value in choices
    }
    return df.withColumns(columns)


def training_set(
    extract: DataFrame, values: dict[str, list] | None = None, key: str = "execution_key", target: str = "success_rate"
) -> tuple[DataFrame, list[str]]:
    """The table of key, features and target, and the feature names. NULL features become 0.

    `extract` should be a stored table: the thresholds take a few passes over its narrow columns.
    """
    cleaned = clean_training(extract, key)
    values = category_values(cleaned) if values is None else values
    wide = one_hot(cleaned, values)
    flags = [name for name in CATEGORIES if name.startswith("contains_")]
    dummies = [f"{name}_{value}" for name, choices in values.items() for value in choices]
    features = [name for name in NUMERIC if name in wide.columns] + flags + dummies
    zero = F.lit(0.0)
    selected = [F.coalesce(F.col(name).cast("double"), zero).alias(name) for name in features]
    return wide.select(key, *selected, F.coalesce(F.col(target), zero).alias(target)), features


def train_val_test(df: DataFrame, key: str = "execution_key", seed: int = 42) -> DataFrame:
    """70/15/15 with exact sizes, as a column."""
    return with_split(df, key, {"train": 0.70, "val": 0.15, "test": 0.15}, seed)


def stratified_train_test(df: DataFrame, label: str, key: str = "execution_key", seed: int = 42) -> DataFrame:
    """80/20 within every label."""
    return with_split(df, key, {"train": 0.8, "test": 0.2}, seed, strata=label)
