"""Table schemas as DDL, and the helper that makes a DataFrame conform to one."""

from __future__ import annotations

from pyspark.sql import DataFrame

# --- raw sources -----------------------------------------------------------------------------
RAW_CHAT = "id string, conversations array<struct<from: string, value: string>>"
RAW_CODE_CHAT = "conversations array<struct<from: string, value: string>>"
RAW_ARENA = (
    "question_id string, model_a string, model_b string, winner string, "
    "conversation_a array<struct<content: string, role: string>>, "
    "conversation_b array<struct<content: string, role: string>>, "
    "turn int, language string, tstamp string"
)
RAW_LIBRARY = "act string, prompt string, type string, for_devs boolean"

# --- normalized events -----------------------------------------------------------------------
PROMPT_EVENT = (
    "conversation_id string, turn_number int, prompt_text string, timestamp timestamp, dataset_name string, "
    "response_text string, model_name string, task_type string, programming_lang string, prompt_type string, "
    "language string, task_category string, quality_label string, success_score double"
)
COMPARISON_EVENT = (
    "conversation_id string, prompt_text string, model_a string, model_b string, winner string, "
    "timestamp timestamp, dataset_name string"
)

# --- staged records --------------------------------------------------------------------------
PROMPT_STAGE = (
    "conversation_id string, turn_number int, prompt_text string, prompt_hash string, prompt_length int, "
    "token_estimate int, prompt_type string, contains_code boolean, contains_examples boolean, "
    "contains_constraints boolean, language string, complexity_score double, instruction_density double, "
    "length int, token_count int, type string, response_text string, response_tokens int, tokens int, "
    "latency double, quality_label string, success_score double, model_name string, task_type string, "
    "domain string, programming_lang string, difficulty string, benchmark_id string, task_category string, "
    "timestamp timestamp, session_id string, dataset_name string, collection_method string, version string, "
    "ingest_timestamp timestamp, batch_id string"
)
COMPARISON_STAGE = (
    "conversation_id string, prompt_text string, prompt_hash string, prompt_length int, token_estimate int, "
    "prompt_type string, contains_code boolean, contains_examples boolean, contains_constraints boolean, "
    "language string, complexity_score double, instruction_density double, length int, token_count int, "
    "type string, timestamp timestamp, dataset_name string, collection_method string, version string, "
    "ingest_timestamp timestamp, batch_id string, model_a string, model_b string, winner string"
)

# --- warehouse -------------------------------------------------------------------------------
DIM_PROMPT = (
    "prompt_key string, prompt_text string, prompt_hash string, prompt_length int, token_estimate int, "
    "prompt_type string, contains_code boolean, contains_examples boolean, contains_constraints boolean, "
    "language string, complexity_score double, instruction_density double, length int, token_count int, type string"
)
DIM_MODEL = (
    "model_key bigint, model_name string, version string, provider string, param_count bigint, "
    "context_window int, release_date date"
)
DIM_TASK = (
    "task_key bigint, task_type string, domain string, language string, programming_lang string, "
    "difficulty string, benchmark_id string, category string"
)
DIM_TIME = (
    "time_key bigint, ts timestamp, year int, quarter int, month int, day int, day_of_week int, "
    "week_number int, is_weekend boolean"
)
DIM_SESSION = (
    "session_key string, session_id string, user_context string, environment string, config_flags string, "
    "runtime_version string"
)
DIM_SOURCE = (
    "source_key bigint, dataset_name string, collection_method string, version string, "
    "ingest_timestamp timestamp, batch_id string"
)
FACT_EXECUTION = (
    "conversation_id string, turn_number int, prompt_key string, model_key bigint, task_key bigint, "
    "time_key bigint, session_key string, source_key bigint, response_text string, tokens int, "
    "response_tokens int, latency double, quality_label string, success_score double"
)
FACT_COMPARISON = (
    "conversation_id string, prompt_key string, model_a_key bigint, model_b_key bigint, "
    "winner_model_key bigint, time_key bigint, source_key bigint"
)
WAREHOUSE = {
    "dim_prompt": DIM_PROMPT,
    "dim_model": DIM_MODEL,
    "dim_task": DIM_TASK,
    "dim_time": DIM_TIME,
    "dim_session": DIM_SESSION,
    "dim_source": DIM_SOURCE,
    "fact_promptexecution": FACT_EXECUTION,
    "fact_model_comparison": FACT_COMPARISON,
}


def fields(ddl: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a flat DDL string."""
    parts, depth, start = [], 0, 0
    for at, char in enumerate(ddl):
        depth += (char == "<") - (char == ">")
        if char == "," and depth == 0:
            parts.append(ddl[start:at])
            start = at + 1
    parts.append(ddl[start:])
    return [tuple(part.strip().split(" ", 1)) for part in parts]


def names(ddl: str) -> list[str]:
    return [name for name, _ in fields(ddl)]


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Columns of the schema in its order; missing ones become NULL, unusable values too."""
    present = set(df.columns)
    return df.selectExpr(
        *[
            f"try_cast({f'`{name}`' if name in present else 'NULL'} AS {kind}) AS `{name}`"
            for name, kind in fields(ddl)
        ]
    )
