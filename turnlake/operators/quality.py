"""Contract cleaning, record validation, stage hygiene and reject accounting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlake import schemas
from turnlake.functions.text import clean_label, clean_payload, sha256, strip
from turnlake.functions.times import contract_timestamp, iso_timestamp, utc_timestamp

# The fields of the event contract.
CONTRACT_FIELDS = ("prompt_text", "task_type", "model", "timestamp", "tokens", "success_score")
# The text columns of the stages that are labels, not payloads.
LABEL_FIELDS = (
    "conversation_id", "prompt_type", "language", "type", "quality_label", "task_type", "domain",
    "programming_lang", "difficulty", "benchmark_id", "task_category", "session_id", "dataset_name",
    "collection_method", "version", "batch_id", "model_name", "model_a", "model_b", "winner",
)


def clean_contract(df: DataFrame) -> DataFrame:
    """Rows that meet the data contract, trimmed and cast; `latency` is optional and may become NULL."""
    absent = [name for name in CONTRACT_FIELDS if name not in df.columns]
    if absent:
        raise ValueError(f"contract fields missing: {', '.join(absent)}")
    casts = {
        "prompt_text": strip(F.col("prompt_text")),
        "task_type": strip(F.col("task_type")),
        "model": strip(F.col("model")),
        "timestamp": contract_timestamp(F.col("timestamp")),
        "tokens": F.col("tokens").try_cast("int"),
        "success_score": F.col("success_score").try_cast("double"),
    }
    if "latency" in df.columns:
        casts["latency"] = F.col("latency").try_cast("double")
    return df.withColumns(casts).dropna(subset=["timestamp", "tokens", "success_score"])


# --- JSON lines ------------------------------------------------------------------------------
# A line is parsed once; every field it is judged by becomes `k_<field>` (its JSON type, NULL when absent) and
# `t_<field>` (its value as text).

PROMPT_FIELDS = (
    "conversation_id", "turn_number", "prompt_text", "prompt_hash", "prompt_length", "token_estimate", "timestamp",
    "dataset_name", "tokens", "response_tokens", "success_score",
)
COMPARISON_FIELDS = (
    "conversation_id", "prompt_text", "prompt_hash", "timestamp", "dataset_name", "model_a", "model_b", "winner",
)


def _is_text(name: str) -> Column:
    return F.col(f"k_{name}") == "STRING"


def _text(name: str) -> Column:
    return F.col(f"t_{name}")


def _present(name: str) -> Column:
    return F.col(f"k_{name}").isNotNull()


def _filled(name: str) -> Column:
    return _is_text(name) & (strip(_text(name)) != "")


def _is_number(name: str) -> Column:
    return F.col(f"k_{name}").rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*|BOOLEAN)$")


def _whole(name: str) -> Column:
    return _is_number(name) | (_is_text(name) & strip(_text(name)).rlike(r"^[+-]?\d+$"))


def _real(name: str) -> Column:
    return _is_number(name) | (_is_text(name) & strip(_text(name)).try_cast("double").isNotNull())


def _missing(name: str) -> Column:
    return ~_present(name) | (F.col(f"k_{name}") == "VOID")


def _time(name: str = "timestamp") -> Column:
    return _is_text(name) & iso_timestamp(_text(name)).isNotNull()


def prompt_rules() -> dict[str, Column]:
    """One boolean per rule for a prompt record."""
    rules = {f"{name}_filled": _filled(name) for name in ("conversation_id", "prompt_text", "dataset_name")}
    rules["prompt_hash_64"] = _is_text("prompt_hash") & (F.length(_text("prompt_hash")) == 64)
    rules["timestamp_iso"] = _time()
    rules |= {f"{name}_whole": _whole(name) for name in ("turn_number", "prompt_length", "token_estimate", "tokens")}
    rules["response_tokens_whole"] = _missing("response_tokens") | _whole("response_tokens")
    rules["success_score_real"] = _missing("success_score") | _real("success_score")
    return rules


def comparison_rules() -> dict[str, Column]:
    """One boolean per rule for a comparison record."""
    rules = {f"{name}_present": _present(name) for name in ("conversation_id", "prompt_hash", "dataset_name", "winner")}
    rules |= {f"{name}_filled": _filled(name) for name in ("prompt_text", "model_a", "model_b")}
    rules["timestamp_iso"] = _time()
    return rules


RULES = {"prompt": (PROMPT_FIELDS, prompt_rules), "comparison": (COMPARISON_FIELDS, comparison_rules)}


def validated(lines: DataFrame, kind: str = "prompt") -> DataFrame:
    """JSON lines (column `value`) with one column per rule and `valid`; blank lines are skipped."""
    names, rules_of = RULES[kind]
    parsed = lines.where(strip(F.col("value")) != "").withColumn("record", F.try_parse_json(F.col("value")))
    fields = [f"try_variant_get(record, '$.{name}', 'variant') AS v_{name}" for name in names]
    kinds = [f"schema_of_variant(v_{name}) AS k_{name}" for name in names]
    texts = [f"try_variant_get(v_{name}, '$', 'string') AS t_{name}" for name in names]
    taken = parsed.selectExpr("value", *fields).selectExpr("value", *kinds, *texts)
    rules = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules_of().items()}
    judged = taken.select("value", *[rule.alias(name) for name, rule in rules.items()])
    return judged.withColumn("valid", reduce(Column.__and__, [F.col(name) for name in rules]))


def validity_report(lines: DataFrame, kind: str = "prompt") -> DataFrame:
    """One row {total, valid, invalid}; unreadable JSON counts as invalid."""
    return validated(lines, kind).agg(
        F.count("*").alias("total"),
        F.count_if("valid").alias("valid"),
        F.count_if(~F.col("valid")).alias("invalid"),
    )


def require_valid(lines: DataFrame, kind: str = "prompt") -> DataFrame:
    """Strict form: the job fails on the first invalid record."""
    checked = validated(lines, kind)
    message = F.concat(F.lit(f"invalid {kind} record: "), F.col("value"))
    return checked.where(F.when(F.col("valid"), True).otherwise(F.raise_error(message).cast("boolean"))).select("value")


# --- staging ---------------------------------------------------------------------------------


def staged(records: DataFrame, kind: str = "prompt") -> DataFrame:
    """Cleaned rows of the staging schema plus `rejected` (no prompt hash and no text to make one from)."""
    ddl = schemas.PROMPT_STAGE if kind == "prompt" else schemas.COMPARISON_STAGE
    text = {"prompt_text": clean_payload(F.col("prompt_text"))}
    if "response_text" in records.columns:
        text["response_text"] = clean_payload(F.col("response_text"))
    labels = {name: clean_label(F.col(name)) for name in LABEL_FIELDS if name in records.columns}
    times = {
        name: utc_timestamp(F.col(name)) if dict(records.dtypes)[name] != "timestamp" else F.col(name)
        for name in ("timestamp", "ingest_timestamp")
        if name in records.columns
    }
    given = F.lower(clean_label(F.col("prompt_hash"))) if "prompt_hash" in records.columns else F.lit(None).cast("string")
    cleaned = records.withColumns(text | labels | times)
    rebuilt = F.coalesce(F.nullif(given, F.lit("")), sha256(F.nullif(F.col("prompt_text"), F.lit(""))))
    conformed = schemas.conform(cleaned.withColumn("prompt_hash", rebuilt), ddl)
    return conformed.withColumn("rejected", F.col("prompt_hash").isNull())


def accepted(stage: DataFrame) -> DataFrame:
    return stage.where(~F.col("rejected")).drop("rejected")


def load_counts(stage: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: rows processed, staged, loaded and rejected (never below 0)."""
    seen = stage.groupBy(*keys).agg(F.count("*").alias("processed"), F.count_if(~F.col("rejected")).alias("staged"))
    loaded = facts.groupBy(*keys).agg(F.count("*").alias("loaded"))
    both = seen.join(loaded, keys, "left").withColumn("loaded", F.coalesce("loaded", F.lit(0)))
    hygiene = F.col("processed") - F.col("staged")
    return both.withColumn("rejected", hygiene + F.greatest(F.col("staged") - F.col("loaded"), F.lit(0)))
