"""The given tables seen as the raw sources of the warehouse.

`conversations` are chat logs, `documents` give code chats, battles and a prompt library, `events` are executions.
The text of the tables is synthetic and holds no code, examples or instructions, so fixed snippets are appended
(a different one per row, chosen by its number) to make every feature and rule occur.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnlake import schemas
from turnlake.functions.text import literal
from turnlake.operators import star
from turnlake.operators.adapters import union_events
from turnlake.operators.features import with_prompt_features
from turnlake.operators.rollups import FLAGS
from turnlake.plans.transform import transform_rows
from turnlake.session import stored, use_utc
from turnlake.sources.raw import spread

RUN_TS = dt.datetime(2024, 2, 1, 12, 30, 0, tzinfo=dt.timezone.utc)
CHAT, CODE, ARENA, LIBRARY = (
    "sharegpt_conversation_chronicles",
    "sharegpt_code_interpreter",
    "chatbot_arena",
    "prompt_library",
)

PROMPT_SNIPPETS = (
    "",
    "\n```python\nprint('hi')\n```\nPlease explain this code.",
    " Act as a reviewer. You must write code, and only SQL.",
    " For example: fix the bug, e.g. in the shell script. Do not guess.",
    "\n\tGenerate　a  table step by step; it should convert\xa0units.",
    " debug this ```js\nlet x = 1;\n``` and prefix the output",
    " create a yaml file ```unknown\nx\n```",
)
REPLY_SNIPPETS = ("", "\n```sql\nSELECT 1;\n```", " Here is some Java and Rust.", "\r\n```py\nx = 1\n```\r\ndone", " ok")
WINNERS = ("model_a", "model_b", "tie", "draw", "Tie (both bad)", " MODEL_A ", "", None)
STAMPS = ("1706000000.25", "2024-01-20T10:11:12Z", "not a time", "", "2024-01-21 01:02:03", None)
LABELS = {"en": "English", "fr": "French", "de": "german", "es": "Klingon"}
EVENT_SOURCES = {"purchase": "Chatbot Arena", "signup": "arena-extra", "click": "sharegpt_chat"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{folder}/{name}.parquet")


def text_table(spark: SparkSession, folder: str, name: str, *keys: str) -> DataFrame:
    """A table whose text is worked on: its rows are spread over all cores."""
    return spread(table(spark, folder, name), *keys)


def chosen(values: tuple, number: str) -> Column:
    """The value at `number` (an expression) modulo the number of values."""
    options = ", ".join("NULL" if value is None else literal(value) for value in values)
    return F.expr(f"get(array({options}), cast(pmod({number}, {len(values)}) AS int))")


# --- chat logs -------------------------------------------------------------------------------


def chat_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Flat messages (conversation_id, turn, role, text)."""
    rows = table(spark, folder, "conversations")
    prompt = chosen(PROMPT_SNIPPETS, "conv_id + turn")
    reply = chosen(REPLY_SNIPPETS, "conv_id + turn")
    return rows.select(
        F.col("conv_id").cast("string").alias("conversation_id"),
        "turn",
        "role",
        F.concat("text", F.when(F.col("role") == "user", prompt).otherwise(reply)).alias("text"),
    )


# --- documents -------------------------------------------------------------------------------


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a snippet and, where labelled, a success score in {0, 0.5, 1}."""
    labels = table(spark, folder, "labels")
    scored = labels.select("doc_id", ((F.col("quality") + 1 - F.col("toxic")) / 2).alias("success_score"))
    docs = text_table(spark, folder, "documents", "doc_id").join(scored, "doc_id", "left")
    return docs.withColumn("text", F.concat("text", chosen(PROMPT_SNIPPETS, "doc_id")))


def plain_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of `documents` without what labels say: a document comes once for each of its labels, at least once. Only
    labels of the same document are joined, if there are any, so texts stay where they lie.
    """
    docs = text_table(spark, folder, "documents", "doc_id")
    several = table(spark, folder, "labels").groupBy("doc_id").agg(F.count("*").alias("_n")).where("_n > 1")
    if not several.isEmpty():
        docs = docs.join(stored(several, "several-labels"), "doc_id", "left")
        again = F.explode(F.array_repeat(F.lit(0), F.coalesce("_n", F.lit(1)).cast("int")))
        docs = docs.withColumn("_again", again).drop("_n", "_again")
    return docs.withColumn("text", F.concat("text", chosen(PROMPT_SNIPPETS, "doc_id")))


ROLES = ("human", "gpt", " User ", "BOT", "system", "user", "assistant")


def code_chats(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's lines as the messages of one conversation."""
    roles = F.array(*[F.lit(role) for role in ROLES])
    messages = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            F.get(roles, F.pmod(i + F.col("doc_id"), F.lit(len(ROLES))).cast("int")).alias("from"), line.alias("value")
        ),
    )
    return plain_documents(spark, folder).select(messages.alias("conversations"))


def battles(spark: SparkSession, folder: str) -> DataFrame:
    """Each document as a battle: its lines go to side A and, in reverse order, to side B."""
    number = F.col("doc_id")
    lines = F.split("text", "\n")

    def side(values: Column, user_at: int) -> Column:
        return F.transform(
            values,
            lambda line, i: F.struct(
                line.alias("content"), F.when(i == user_at, "user").otherwise("assistant").alias("role")
            ),
        )

    a = F.when(F.pmod(number, F.lit(9)) == 4, side(lines, -1)).otherwise(side(lines, 0))
    return plain_documents(spark, folder).select(
        F.when(F.pmod(number, F.lit(13)) != 5, number.cast("string")).alias("question_id"),
        F.concat(F.lit("m"), F.pmod(number, F.lit(7)).cast("string")).alias("model_a"),
        F.concat(F.lit(" m"), F.pmod(number, F.lit(5)).cast("string"), F.lit(" ")).alias("model_b"),
        chosen(WINNERS, "doc_id").alias("winner"),
        a.alias("conversation_a"),
        side(F.reverse(lines), 0).alias("conversation_b"),
        F.when(F.pmod(number, F.lit(3)) > 0, F.pmod(number, F.lit(3))).cast("int").alias("turn"),
        F.element_at(F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair]), F.col("lang")).alias("language"),
        chosen(STAMPS, "doc_id").alias("tstamp"),
    )


def library(spark: SparkSession, folder: str) -> DataFrame:
    """Each document as a library entry."""
    return plain_documents(spark, folder).select(
        F.concat(F.lit("Act #"), "source", F.lit(" (v1)!")).alias("act"),
        F.col("text").alias("prompt"),
        F.when(F.pmod("doc_id", F.lit(4)) > 0, F.concat(F.lit("Type "), F.upper("lang"))).alias("type"),
        (F.pmod("doc_id", F.lit(2)) == 0).alias("for_devs"),
    )


# --- records of all sources ------------------------------------------------------------------


def nested_chats(spark: SparkSession, folder: str) -> DataFrame:
    """Code chats under an id: the same messages as a chat log with in-row conversations."""
    return code_chats(spark, folder).select(F.lit(None).cast("string").alias("id"), "conversations")


def flat_chat_records(spark: SparkSession, folder: str) -> DataFrame:
    """Prompt records of the flat chat log."""
    from turnlake.operators.features import prompt_records, with_lineage
    from turnlake.operators.turns import turn_pairs
    from turnlake.functions.times import instant

    pairs = turn_pairs(chat_messages(spark, folder))
    events = schemas.conform(
        pairs.withColumns({"timestamp": instant(RUN_TS), "dataset_name": F.lit(CHAT)}), schemas.PROMPT_EVENT
    )
    lineage = with_lineage(prompt_records(events), RUN_TS, CHAT, "fixture", "test")
    return schemas.conform(lineage, schemas.PROMPT_STAGE)


RAW = {CODE: code_chats, ARENA: battles, LIBRARY: library}


def prompt_stage(spark: SparkSession, folder: str) -> DataFrame:
    """Prompt records of all four sources."""
    parts = [transform_rows(name, rows(spark, folder), RUN_TS)[0] for name, rows in RAW.items()]
    return union_events([flat_chat_records(spark, folder), *parts])


def comparison_stage(spark: SparkSession, folder: str) -> DataFrame:
    return transform_rows(ARENA, battles(spark, folder), RUN_TS)[1]


# --- executions ------------------------------------------------------------------------------


def executions(spark: SparkSession, folder: str) -> DataFrame:
    return as_executions(table(spark, folder, "events"))


def as_executions(events: DataFrame) -> DataFrame:
    """Events (a table or a stream) as executions: which prompt (a document) ran where, how fast and how well."""
    k = F.get_json_object("props", "$.k").cast("int")
    sources = F.create_map(*[F.lit(x) for pair in EVENT_SOURCES.items() for x in pair])
    return events.withColumn("k", k).select(
        F.col("event_id").alias("execution_key"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("user_id").alias("doc_id"),
        F.when(F.pmod("k", F.lit(10)) > 0, F.concat(F.lit("m"), F.pmod("user_id", F.lit(7)).cast("string"))).alias("model_name"),
        F.coalesce(F.try_element_at(sources, F.col("event_type")), F.lit("other")).alias("dataset_name"),
        F.when(F.pmod("k", F.lit(4)) > 0, F.col("value")).alias("latency"),
        F.col("k").alias("tokens"),
        F.when(F.pmod("k", F.lit(3)) > 0, F.floor(F.col("k") / 5).cast("int")).alias("response_tokens"),
        F.when(F.pmod("k", F.lit(11)) > 0, F.pmod("k", F.lit(3)) / 2).alias("success_score"),
    )


def prompts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as prompts with their features; computed once per document, not once per execution."""
    docs = documents(spark, folder).select(
        "doc_id",
        F.col("text").alias("prompt_text"),
        F.col("lang").alias("language"),
        F.lit(None).cast("string").alias("response_text"),
        F.lit(None).cast("string").alias("prompt_type"),
        "success_score",
    )
    return with_prompt_features(docs)


def run_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Execution facts without their prompts."""
    return executions(spark, folder).withColumns(
        {
            "model_key": star.name_key(F.col("model_name")),
            "time_key": star.time_key(F.col("timestamp")),
            "source_key": star.name_key(F.col("dataset_name")),
        }
    )


def run_models(spark: SparkSession, folder: str) -> DataFrame:
    return star.dim_model(executions(spark, folder))


def run_sources(spark: SparkSession, folder: str) -> DataFrame:
    names = executions(spark, folder).select("dataset_name").distinct()
    return schemas.conform(names.withColumn("source_key", star.name_key(F.col("dataset_name"))), schemas.DIM_SOURCE)


def execution_star(spark: SparkSession, folder: str, only: Sequence[str] | None = ("prompt_text", *FLAGS)) -> dict[str, DataFrame]:
    """Executions with their prompts, by default with the flags and the text alone. Prompts are worked on once: their
    features are stored, and the executions get their prompt's hash from there.
    """
    columns = None if only is None else ["doc_id", "prompt_hash", "prompt_length", *only]
    texts = prompts(spark, folder)
    texts = stored(star.numbered(texts if columns is None else texts.select(*columns)), "prompts")
    hashes = texts.select("doc_id", F.col("prompt_hash").alias("prompt_key"))
    return {
        "fact_promptexecution": run_facts(spark, folder).join(hashes, "doc_id"),
        "dim_prompt": star.dim_prompt(texts, only=only, at_rest=True),
    }


def full_star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Executions with the whole prompt dimension."""
    return execution_star(spark, folder, None)


def prompt_facts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Scored documents as facts, and their tasks."""
    stage = schemas.conform(prompts(spark, folder), schemas.PROMPT_STAGE)
    stage = stage.withColumn("conversation_id", F.col("prompt_hash"))
    return star.execution_facts(stage), star.dim_task(stage)
