"""One adapter per raw source: raw rows to prompt events and, for battles, comparisons."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlake import schemas
from turnlake.functions import messages as M
from turnlake.functions.tasks import code_task, slug
from turnlake.functions.text import normalize, programming_language, sha256, strip
from turnlake.functions.times import instant, utc_timestamp


def _or_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def _text_or_null(value: Column) -> Column:
    return _or_null(strip(value))


def _paired(rows: DataFrame, messages: str) -> DataFrame:
    """One output row per turn pair of an in-row conversation; stays inside the scan's partitions."""
    pairs = M.turn_pairs("messages")
    rows = rows.select("conversation_id", M.clean_messages(messages, "from", "value").alias("messages"))
    return rows.select("conversation_id", F.posexplode(pairs).alias("pos", "pair")).select(
        "conversation_id",
        (F.col("pos") + 1).alias("turn_number"),
        F.col("pair.prompt_text").alias("prompt_text"),
        _or_null(F.col("pair.response_text")).alias("response_text"),
    )


def chat_events(rows: DataFrame, run_ts: dt.datetime, dataset: str) -> DataFrame:
    """Chat logs: turn pairs under the row's id, or a content hash when it has none."""
    fallback = M.content_id(dataset, F.col("conversations"), missing="null")
    keyed = rows.withColumn("conversation_id", F.coalesce(_or_null(F.col("id")), fallback))
    return schemas.conform(
        _paired(keyed, "conversations").withColumns({"timestamp": instant(run_ts), "dataset_name": F.lit(dataset)}),
        schemas.PROMPT_EVENT,
    )


def code_chat_events(rows: DataFrame, run_ts: dt.datetime, dataset: str) -> DataFrame:
    """Code chats: as chat logs, with a task type and the programming language."""
    keyed = rows.withColumn("conversation_id", M.content_id(dataset, F.col("conversations"), missing="[]"))
    pairs = _paired(keyed, "conversations")
    return schemas.conform(
        pairs.withColumns(
            {
                "timestamp": instant(run_ts),
                "dataset_name": F.lit(dataset),
                "task_type": code_task(F.col("prompt_text")),
                "programming_lang": programming_language("prompt_text", "response_text"),
            }
        ),
        schemas.PROMPT_EVENT,
    )


def _battles(rows: DataFrame, run_ts: dt.datetime, dataset: str) -> DataFrame:
    """Battles with a prompt on side A or else on side B; others drop out."""
    payload = F.struct(*[F.col(name) for name in sorted(schemas.names(schemas.RAW_ARENA))])
    sides = rows.withColumns(
        {
            "conversation_id": F.coalesce(_or_null(F.col("question_id")), M.content_id(dataset, payload, "null")),
            "timestamp": F.coalesce(utc_timestamp(F.col("tstamp")), instant(run_ts)),
            "_a": M.clean_messages("conversation_a", "role", "content"),
            "_b": M.clean_messages("conversation_b", "role", "content"),
        }
    )
    prompt = F.coalesce(M.first_user_text("_a"), M.first_user_text("_b"))
    return sides.withColumns({"prompt_text": prompt, "dataset_name": F.lit(dataset)}).dropna(subset=["prompt_text"])


def arena_events(rows: DataFrame, run_ts: dt.datetime, dataset: str) -> DataFrame:
    """Two prompt events per battle, one for each model."""
    battles = _battles(rows, run_ts, dataset).withColumn("_outcome", M.outcome("winner"))

    def entrant(letter: str) -> Column:
        return F.struct(
            _text_or_null(F.col(f"model_{letter}")).alias("model_name"),
            _or_null(M.assistant_text(f"_{letter}")).alias("response_text"),
            F.col(f"_outcome.label_{letter}").alias("quality_label"),
            F.col(f"_outcome.score_{letter}").alias("success_score"),
        )

    both = battles.select(
        "conversation_id",
        F.coalesce(F.nullif(F.col("turn"), F.lit(0)), F.lit(1)).alias("turn_number"),
        "prompt_text",
        "timestamp",
        "dataset_name",
        _text_or_null(F.col("language")).alias("language"),
        F.explode(F.array(entrant("a"), entrant("b"))).alias("entrant"),
    )
    return schemas.conform(both.select("*", "entrant.*").drop("entrant"), schemas.PROMPT_EVENT)


def arena_comparisons(rows: DataFrame, run_ts: dt.datetime, dataset: str) -> DataFrame:
    """One comparison per battle."""
    battles = _battles(rows, run_ts, dataset)
    labels = {name: strip(F.coalesce(F.col(name), F.lit(""))) for name in ("model_a", "model_b", "winner")}
    return schemas.conform(battles.withColumns(labels), schemas.COMPARISON_EVENT)


def library_events(rows: DataFrame, run_ts: dt.datetime, dataset: str) -> DataFrame:
    """Prompt library: one event per non-blank prompt, identified by its normalized text."""
    prompt = strip(F.coalesce(F.col("prompt"), F.lit("")))
    kept = rows.withColumn("prompt_text", prompt).where(F.col("prompt_text") != "")
    return schemas.conform(
        kept.select(
            F.concat(F.lit(f"{dataset}:"), sha256(normalize(F.col("prompt_text")))).alias("conversation_id"),
            F.lit(1).alias("turn_number"),
            "prompt_text",
            instant(run_ts).alias("timestamp"),
            F.lit(dataset).alias("dataset_name"),
            slug(F.col("act")).alias("task_type"),
            _text_or_null(F.col("type")).alias("prompt_type"),
            F.when(F.coalesce(F.col("for_devs"), F.lit(False)), "developer").otherwise("general").alias("task_category"),
        ),
        schemas.PROMPT_EVENT,
    )


Events = Callable[[DataFrame, dt.datetime, str], DataFrame]


@dataclass(frozen=True)
class Adapter:
    raw_schema: str
    prompts: Events
    comparisons: Events | None = None


ADAPTERS: dict[str, Adapter] = {
    "sharegpt_conversation_chronicles": Adapter(schemas.RAW_CHAT, chat_events),
    "sharegpt_code_interpreter": Adapter(schemas.RAW_CODE_CHAT, code_chat_events),
    "chatbot_arena": Adapter(schemas.RAW_ARENA, arena_events, arena_comparisons),
    "prompt_library": Adapter(schemas.RAW_LIBRARY, library_events),
}


def adapter_for(dataset: str) -> Adapter:
    if dataset not in ADAPTERS:
        raise ValueError(f"no adapter for dataset {dataset!r}; known: {', '.join(sorted(ADAPTERS))}")
    return ADAPTERS[dataset]


def union_events(parts: list[DataFrame]) -> DataFrame:
    """All sources' events in one DataFrame."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part, allowMissingColumns=True)
    return first
