"""The registered queries: name -> (query, SQL or None)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import SparkRuntimeException
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnlake import schemas
from turnlake.functions import tasks, text, times
from turnlake.operators import adapters, boards, eda, evaluation, language, mining, models, ordered, quality, rollups, scoring
from turnlake.operators import star, training, turns
from turnlake.operators.features import comparison_records, prompt_records, with_lineage
from turnlake.plans import workload as W
from turnlake.plans.warehouse import Warehouse, load_name
from turnlake.session import PACKED, brief_shuffles, new_folder, removed, stored, stored_halves
from turnlake.sources import raw, records
from turnlake.streaming import load as streaming

from checks import sql as S

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
AS_OF = dt.date(2024, 1, 30)
MODELS = [f"m{i}" for i in range(7)]


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


def rounded(df: DataFrame, *names: str, digits: int = S.R) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def as_text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSS") for name in names})


TS = "strftime({0}, '%Y-%m-%dT%H:%M:%S.%g')".format

# --- turns -------------------------------------------------------------------------------------


@query(S.with_(S.PAIRS, "SELECT * FROM pairs"))
def chat_turn_pairs(spark, folder):
    return turns.turn_pairs(W.chat_messages(spark, folder))


@query(
    S.with_(
        S.MESSAGES,
        "SELECT conversation_id, first(body ORDER BY turn) AS prompt_text FROM messages "
        "WHERE side = 'user' AND body <> '' GROUP BY 1",
    )
)
def first_user_message(spark, folder):
    return turns.first_user_message(W.chat_messages(spark, folder))


@query(
    S.with_(
        S.MESSAGES,
        "SELECT conversation_id, row_number() OVER w AS part, "
        "CAST(sum(length(body) + 2) OVER w - length(body) - 2 AS BIGINT) AS char_offset, body AS response_text "
        "FROM messages WHERE side = 'assistant' AND body <> '' WINDOW w AS (PARTITION BY conversation_id ORDER BY turn)",
    )
)
def assistant_transcript(spark, folder):
    return turns.assistant_transcript(W.chat_messages(spark, folder))


@query(S.with_(S.CODE_CHATS, "SELECT * FROM code_pairs"))
def nested_turn_pairs(spark, folder):
    events = adapters.chat_events(W.nested_chats(spark, folder), W.RUN_TS, W.CODE)
    return events.select("conversation_id", "turn_number", "prompt_text", "response_text")


@query(
    S.with_(
        S.CODE_CHATS,
        f"SELECT conversation_id, turn_number, prompt_text, response_text, {S.code_task('prompt_text')} AS task_type, "
        f"{S.prog_lang('prompt_text', 'response_text')} AS programming_lang FROM code_pairs",
    )
)
def code_chat_events(spark, folder):
    events = adapters.code_chat_events(W.code_chats(spark, folder), W.RUN_TS, W.CODE)
    return events.select(
        "conversation_id", "turn_number", "prompt_text", "response_text", "task_type", "programming_lang"
    )


ARENA_COLUMNS = (
    "conversation_id", "turn_number", "prompt_text", "response_text", "model_name", "language", "quality_label",
    "success_score",
)


@query(
    S.with_(
        S.BATTLES,
        "SELECT conversation_id, turn_number, prompt_text, response_text, model_name, language, quality_label, "
        f"CAST(success_score AS DOUBLE) AS success_score, {TS('at_time')} AS timestamp FROM arena",
    )
)
def arena_events(spark, folder):
    events = adapters.arena_events(W.battles(spark, folder), W.RUN_TS, W.ARENA)
    return as_text(events.select(*ARENA_COLUMNS, "timestamp"), "timestamp")


@query(
    S.with_(
        S.COMPARISONS,
        f"SELECT conversation_id, prompt_text, model_a, model_b, winner, {TS('ts')} AS timestamp, dataset_name FROM compared",
    )
)
def arena_comparisons(spark, folder):
    return as_text(adapters.arena_comparisons(W.battles(spark, folder), W.RUN_TS, W.ARENA), "timestamp")


@query(S.with_(S.LIBRARY, "SELECT * FROM entries"))
def prompt_library_events(spark, folder):
    events = adapters.library_events(W.library(spark, folder), W.RUN_TS, W.LIBRARY)
    return events.select("conversation_id", "turn_number", "prompt_text", "task_type", "prompt_type", "task_category")


# --- features ----------------------------------------------------------------------------------

FEATURE_COLUMNS = (
    "prompt_hash", "prompt_length", "token_estimate", "prompt_type", "contains_code", "contains_examples",
    "contains_constraints", "example_count", "constraint_count", "language", "complexity_score",
    "instruction_density", "response_tokens", "tokens", "programming_lang",
)
PAIR_EVENTS = S.PAIRS + """,
pair_events AS (
  SELECT *, CAST(NULL AS VARCHAR) AS language_label, CAST(NULL AS VARCHAR) AS type_label,
    CAST(NULL AS VARCHAR) AS task_label FROM pairs)"""


@query(
    S.with_(
        PAIR_EVENTS + "," + S.features("pair_events", "featured"),
        f"SELECT conversation_id, turn_number, {', '.join(FEATURE_COLUMNS)}, task_type, "
        "sha256(conversation_id) AS session_id, prompt_length AS length, token_estimate AS token_count, "
        "prompt_type AS type FROM featured",
    )
)
def prompt_features(spark, folder):
    pairs = turns.turn_pairs(W.chat_messages(spark, folder))
    featured = prompt_records(schemas.conform(pairs, schemas.PROMPT_EVENT))
    extra = ("task_type", "session_id", "length", "token_count", "type")
    return featured.select("conversation_id", "turn_number", *FEATURE_COLUMNS, *extra)


@query(S.with_(S.PROMPTS, f"SELECT doc_id, {', '.join(FEATURE_COLUMNS)} FROM prompts"))
def document_features(spark, folder):
    return W.prompts(spark, folder).select("doc_id", *FEATURE_COLUMNS)


@query(S.with_(S.DOCS, f"SELECT doc_id, sha256({S.norm('text')}) AS prompt_hash FROM docs"))
def prompt_hashes(spark, folder):
    return W.documents(spark, folder).select("doc_id", text.sha256(text.normalize(F.col("text"))).alias("prompt_hash"))


@query(S.with_(S.DOCS, f"SELECT doc_id, {S.tokens(S.norm('text'))} AS token_estimate, {S.words(S.norm('text'))} AS words FROM docs"))
def token_estimates(spark, folder):
    norm = text.normalize(F.col("text"))
    return W.documents(spark, folder).select(
        "doc_id",
        text.token_estimate(norm).alias("token_estimate"),
        text.word_count(norm).cast("bigint").alias("words"),
    )


@query(S.with_(S.DOCS, f"SELECT doc_id, {S.prog_lang('text', 'NULL')} AS programming_lang FROM docs"))
def programming_language(spark, folder):
    language = text.programming_language("text")
    return W.documents(spark, folder).select("doc_id", language.alias("programming_lang"))


_LABEL = "(CASE WHEN doc_id % 3 = 0 THEN ' Data Analysis! ' WHEN doc_id % 3 = 1 THEN 'Unknown' END)"


@query(
    S.with_(
        S.DOCS,
        f"SELECT doc_id, {S.code_task('text')} AS code_task, {S.task(_LABEL, 'text')} AS task_type, "
        f"{S.slug('source')} AS slug FROM docs",
    )
)
def task_type(spark, folder):
    label = F.expr("CASE WHEN doc_id % 3 = 0 THEN ' Data Analysis! ' WHEN doc_id % 3 = 1 THEN 'Unknown' END")
    body = F.col("text")
    return W.documents(spark, folder).select(
        "doc_id",
        tasks.code_task(body).alias("code_task"),
        tasks.task_type(label, body).alias("task_type"),
        tasks.slug(F.col("source")).alias("slug"),
    )


@query(
    S.with_(
        S.DOCS,
        f"SELECT doc_id, {S.prompt_type('text', S.chosen(('How To', '', None), 'doc_id'))} AS prompt_type, "
        f"{S.spoken(S.chosen(('Mandarin', 'Klingon', '', None), 'doc_id'), S.norm('text'))} AS language FROM docs",
    )
)
def prompt_type_and_language(spark, folder):
    docs = W.documents(spark, folder).withColumn("label", W.chosen(("Mandarin", "Klingon", "", None), "doc_id"))
    return docs.select(
        "doc_id",
        text.prompt_type(F.col("text"), W.chosen(("How To", "", None), "doc_id")).alias("prompt_type"),
        text.spoken_language("text", "label").alias("language"),
    )


@query(S.with_(S.DOCS, f"SELECT doc_id, lang, {S.detected(S.norm('text'))} AS detected FROM docs"))
def language_by_stop_words(spark, folder):
    return W.documents(spark, folder).select("doc_id", "lang", text.detected_language("text").alias("detected"))


def _held_out(spark, folder):
    """Documents with every fifth (in a hash order) held out, and the profile of the others."""
    docs = W.documents(spark, folder).withColumn("held_out", ordered.hash_order(F.col("doc_id"), 42) % 5 == 0)
    return docs, language.fitted(docs.where("not held_out"))


_PROFILE = S.DOCS + "," + S.language_profile(f"SELECT text, lang FROM docs WHERE {S.hash_order('doc_id')} % 5 <> 0")


@query(S.with_(_PROFILE, "SELECT * FROM language_profile"))
def language_profile(spark, folder):
    return _held_out(spark, folder)[1]


@query(
    S.with_(
        _PROFILE + "," + S.profiled("SELECT doc_id AS id, text FROM docs"),
        f"SELECT doc_id, lang, coalesce(detected, 'unknown') AS detected, {S.hash_order('doc_id')} % 5 = 0 AS held_out "
        "FROM docs LEFT JOIN profiled ON id = doc_id",
    )
)
def detected_language(spark, folder):
    """The language of every document by a profile that was fitted on four fifths of them."""
    docs, table = _held_out(spark, folder)
    return docs.select("doc_id", "lang", language.Profile.read(table).detected("text").alias("detected"), "held_out")


@query(
    S.with_(
        S.PAIRS + "," + _PROFILE + "," + S.profiled("SELECT conversation_id || ':' || turn_number AS id, prompt_text AS text FROM pairs"),
        "SELECT conversation_id, turn_number, coalesce(detected, 'unknown') AS language FROM pairs "
        "LEFT JOIN profiled ON id = conversation_id || ':' || turn_number",
    )
)
def prompt_languages(spark, folder):
    """Languages of unlabelled chat prompts, by the profile of the labelled documents."""
    profile = language.Profile.read(_held_out(spark, folder)[1])
    pairs = turns.turn_pairs(W.chat_messages(spark, folder))
    return prompt_records(schemas.conform(pairs, schemas.PROMPT_EVENT), profile).select("conversation_id", "turn_number", "language")


# --- quality -----------------------------------------------------------------------------------

_HASH = "CASE WHEN event_id % 11 = 0 THEN 'short' ELSE sha256(event_type) END"
_LINE_SQL = f"""
json_lines AS (
  SELECT CASE WHEN event_id % 23 = 0 THEN '{{broken' WHEN event_id % 29 = 0 THEN '  ' ELSE CAST(to_json({{
    'conversation_id': CASE WHEN event_id % 13 = 0 THEN ' ' ELSE CAST(user_id AS VARCHAR) END,
    'turn_number': 1, 'prompt_text': event_type, 'prompt_hash': {_HASH}, 'prompt_length': 3,
    'token_estimate': CASE WHEN event_id % 17 = 0 THEN 'many' ELSE '7' END, 'timestamp':
      CASE WHEN event_id % 19 = 0 THEN 'yesterday' ELSE '2024-01-05T10:00:00Z' END,
    'dataset_name': 'd', 'tokens': CAST(json_extract(props, '$.k') AS INTEGER),
    'response_tokens': CASE WHEN event_id % 7 = 0 THEN 'x' END, 'success_score': value,
    'model_a': CASE WHEN event_id % 5 = 0 THEN '' ELSE 'm' END, 'model_b': 'n', 'winner': NULL}}) AS VARCHAR) END AS value
  FROM events),
parsed AS (SELECT value, TRY_CAST(value AS JSON) AS j FROM json_lines WHERE trim(value) <> ''),
judged AS (SELECT coalesce(
    trim(j->>'$.conversation_id') <> '' AND length(j->>'$.prompt_hash') = 64 AND (j->>'$.token_estimate') = '7'
    AND (j->>'$.timestamp') LIKE '2024%' AND (j->>'$.response_tokens') IS NULL, false) AS prompt_ok,
  coalesce((j->>'$.model_a') <> '' AND (j->>'$.timestamp') LIKE '2024%', false) AS comparison_ok FROM parsed)"""


def _json_lines(spark, folder):
    number = F.col("event_id")

    def every(n: int, value: str | None, otherwise) -> F.Column:
        return F.when(number % n == 0, F.lit(value)).otherwise(otherwise)

    record = F.struct(
        every(13, " ", F.col("user_id").cast("string")).alias("conversation_id"),
        F.lit(1).alias("turn_number"),
        F.col("event_type").alias("prompt_text"),
        every(11, "short", text.sha256(F.col("event_type"))).alias("prompt_hash"),
        F.lit(3).alias("prompt_length"),
        every(17, "many", F.lit("7")).alias("token_estimate"),
        every(19, "yesterday", F.lit("2024-01-05T10:00:00Z")).alias("timestamp"),
        F.lit("d").alias("dataset_name"),
        F.get_json_object("props", "$.k").cast("int").alias("tokens"),
        F.when(number % 7 == 0, "x").alias("response_tokens"),
        F.col("value").alias("success_score"),
        every(5, "", F.lit("m")).alias("model_a"),
        F.lit("n").alias("model_b"),
        F.lit(None).cast("string").alias("winner"),
    )
    as_json = F.to_json(record, {"ignoreNullFields": "false"})
    line = F.when(number % 23 == 0, "{broken").when(number % 29 == 0, "  ").otherwise(as_json)
    return W.text_table(spark, folder, "events", "event_id").select(line.alias("value"))


def _report_sql(flag: str) -> str:
    return S.with_(
        _LINE_SQL,
        f"SELECT count(*) AS total, count(*) FILTER (WHERE {flag}) AS valid, count(*) FILTER (WHERE NOT {flag}) AS invalid FROM judged",
    )


@query(_report_sql("prompt_ok"))
def prompt_validity_report(spark, folder):
    return quality.validity_report(_json_lines(spark, folder), "prompt")


@query(_report_sql("comparison_ok"))
def comparison_validity_report(spark, folder):
    return quality.validity_report(_json_lines(spark, folder), "comparison")


_CONTRACT = S.with_(
    """
written AS (
  SELECT event_id, ' ' || event_type || chr(9) AS prompt_text, event_type AS task_type, 'm' || (user_id % 7) AS model,
    CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
      WHEN 2 THEN strftime(ts, '%Y/%m/%d %H:%M:%S') WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') ELSE 'soon' END AS timestamp,
    CASE WHEN event_id % 7 = 3 THEN 'n/a' ELSE json_extract_string(props, '$.k') END AS tokens,
    CASE WHEN event_id % 11 <> 2 THEN CAST(value AS VARCHAR) END AS success_score,
    CASE WHEN event_id % 3 = 0 THEN 'slow' ELSE CAST(value AS VARCHAR) END AS latency FROM events),
read_ AS (
  SELECT event_id, trim(prompt_text, ' ' || chr(9)) AS prompt_text, task_type, model,
    coalesce(try_strptime(timestamp, ['%Y-%m-%dT%H:%M:%S', '%Y-%m-%d %H:%M:%S', '%Y/%m/%d %H:%M:%S', '%Y-%m-%dT%H:%M:%SZ'])) AS at_time,
    TRY_CAST(tokens AS INTEGER) AS tokens, TRY_CAST(success_score AS DOUBLE) AS success_score, TRY_CAST(latency AS DOUBLE) AS latency
  FROM written)""",
    f"""SELECT * EXCLUDE (at_time), {TS('at_time')} AS timestamp FROM read_
    WHERE at_time IS NOT NULL AND tokens IS NOT NULL AND success_score IS NOT NULL""",
)


@query(_CONTRACT)
def clean_events(spark, folder):
    number = F.col("event_id")
    k = F.get_json_object("props", "$.k")
    forms = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'"]
    written = F.get(F.array(*[F.date_format("ts", form) for form in forms], F.lit("soon")), (number % 5).cast("int"))
    raw_rows = W.table(spark, folder, "events").select(
        "event_id",
        F.concat(F.lit(" "), "event_type", F.lit("\t")).alias("prompt_text"),
        F.col("event_type").alias("task_type"),
        F.concat(F.lit("m"), (F.col("user_id") % 7).cast("string")).alias("model"),
        written.alias("timestamp"),
        F.when(number % 7 == 3, "n/a").otherwise(k).alias("tokens"),
        F.when(number % 11 == 2, None).otherwise(F.col("value").cast("string")).alias("success_score"),
        F.when(number % 3 == 0, "slow").otherwise(F.col("value").cast("string")).alias("latency"),
    )
    return as_text(quality.clean_contract(raw_rows), "timestamp")


def _dirty_records(spark, folder):
    """Messages as records with control characters, missing hashes and mixed time formats."""
    number = F.col("conv_id") + F.col("turn")
    return W.table(spark, folder, "conversations").select(
        F.concat(F.lit(" c"), F.col("conv_id").cast("string"), F.lit("\r\n")).alias("conversation_id"),
        F.col("turn").cast("int").alias("turn_number"),
        F.when(number % 9 == 5, "").otherwise(F.concat(F.lit("\x00a\r\nb\rc "), "text")).alias("prompt_text"),
        F.when(number % 3 == 0, F.upper(text.sha256(F.col("text")))).alias("prompt_hash"),
        W.chosen(W.STAMPS, "conv_id + turn").alias("timestamp"),
        F.concat(F.lit("\x00"), "role").alias("dataset_name"),
    )


_DIRTY = f"""
dirty AS (
  SELECT 'c' || conv_id AS conversation_id, CAST(turn AS INTEGER) AS turn_number,
    CASE WHEN (conv_id + turn) % 9 = 5 THEN '' ELSE 'a' || chr(10) || 'b' || chr(10) || 'c ' || replace(text, chr(13), chr(10)) END AS prompt_text,
    CASE WHEN (conv_id + turn) % 3 = 0 THEN sha256(text) END AS given,
    CASE (conv_id + turn) % 6 WHEN 0 THEN '2024-01-23T08:53:20.250' WHEN 1 THEN '2024-01-20T10:11:12.000'
      WHEN 4 THEN '2024-01-21T01:02:03.000' END AS timestamp, role AS dataset_name FROM conversations),
staged AS (
  SELECT * EXCLUDE (given), coalesce(given, CASE WHEN prompt_text <> '' THEN sha256(prompt_text) END) AS prompt_hash FROM dirty)"""


@query(S.with_(_DIRTY, "SELECT *, prompt_hash IS NULL AS rejected FROM staged"))
def stage_hygiene(spark, folder):
    kept = ("conversation_id", "turn_number", "prompt_text", "prompt_hash", "timestamp", "dataset_name", "rejected")
    return as_text(quality.staged(_dirty_records(spark, folder)).select(*kept), "timestamp")


@query(
    S.with_(
        _DIRTY,
        "SELECT dataset_name, count(*) AS processed, count(prompt_hash) AS staged, count(prompt_hash) AS loaded, "
        "count(*) - count(prompt_hash) AS rejected FROM staged GROUP BY 1",
    )
)
def reject_audit(spark, folder):
    stage = quality.staged(_dirty_records(spark, folder))
    facts = quality.accepted(stage).select("dataset_name")
    return quality.load_counts(stage, facts, ["dataset_name"])


# --- star --------------------------------------------------------------------------------------


def _stage(spark, folder):
    return W.prompt_stage(spark, folder)


def _stage_halves(spark, folder, condition) -> list[tuple[DataFrame, str]]:
    """The stage worked out once, in two tables that can go one by one."""
    with brief_shuffles(spark):
        return stored_halves(_stage(spark, folder), condition, "stage", **PACKED)


_PROMPT_COLUMNS = [name for name in schemas.names(schemas.DIM_PROMPT) if name not in ("prompt_key", "type")]


@query(
    S.with_(
        S.STAGE,
        f"""SELECT {', '.join(c for c in _PROMPT_COLUMNS if c not in ('length', 'token_count'))}, prompt_length AS length,
        token_estimate AS token_count FROM (SELECT *, row_number() OVER (PARTITION BY prompt_hash
        ORDER BY prompt_length DESC, prompt_text, token_estimate, prompt_type, contains_code, contains_examples,
        contains_constraints, language, complexity_score, instruction_density) AS place FROM stage) WHERE place = 1""",
    )
)
def dim_prompt(spark, folder):
    return star.dim_prompt(_stage(spark, folder)).select(*_PROMPT_COLUMNS)


_FIRST = ("ts", "conversation_id", "turn_number", "prompt_text", "token_estimate", "prompt_type", "contains_code", "contains_examples",
          "contains_constraints", "language", "complexity_score", "instruction_density")


@query(
    S.with_(
        S.STAGE,
        f"""SELECT {', '.join(c for c in _PROMPT_COLUMNS if c not in ('length', 'token_count'))}, prompt_length AS length,
        token_estimate AS token_count FROM (SELECT *, row_number() OVER (PARTITION BY prompt_hash
        ORDER BY {', '.join(c + ' NULLS FIRST' for c in _FIRST)}) AS place FROM stage) WHERE place = 1""",
    )
)
def dim_prompt_first_variant(spark, folder):
    arrival = ("timestamp", "conversation_id", "turn_number")
    return star.dim_prompt(_stage(spark, folder), "first", arrival).select(*_PROMPT_COLUMNS)


@query(
    S.with_(
        S.STAGE + "," + S._after_docs(S.COMPARISONS).replace(S._after_docs(S.BATTLES) + ",", ""),
        "SELECT model_name FROM stage WHERE model_name <> '' UNION SELECT model_a FROM compared WHERE model_a <> '' "
        "UNION SELECT model_b FROM compared WHERE model_b <> ''",
    )
)
def dim_model(spark, folder):
    of_prompts = star.dim_model(_stage(spark, folder))
    of_battles = star.dim_model_of_comparisons(W.comparison_stage(spark, folder))
    return star.insert_if_absent(of_prompts, of_battles, "model_key").select("model_name")


@query(
    S.with_(
        S.STAGE,
        "SELECT DISTINCT task_type, language, programming_lang, task_category AS category FROM stage",
    )
)
def dim_task(spark, folder):
    return star.dim_task(_stage(spark, folder)).select("task_type", "language", "programming_lang", "category")


@query(
    S.with_(
        S.RUNS,
        f"""SELECT {TS('ts')} AS ts, CAST(year(ts) AS INTEGER) AS year, CAST(quarter(ts) AS INTEGER) AS quarter,
        CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day, CAST(isodow(ts) AS INTEGER) AS day_of_week,
        CAST(week(ts) AS INTEGER) AS week_number, isodow(ts) >= 6 AS is_weekend FROM (SELECT DISTINCT ts FROM runs)""",
    )
)
def dim_time(spark, folder):
    return as_text(star.dim_time(W.executions(spark, folder)).drop("time_key"), "ts")


@query(S.with_(S.STAGE, "SELECT DISTINCT sha256(conversation_id) AS session_id FROM stage"))
def dim_session(spark, folder):
    return star.dim_session(_stage(spark, folder)).select("session_id")


_SOURCES = f"""
versions AS (
  SELECT event_type AS dataset_name, 'v' || (user_id % 3) AS version, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ingest,
    'b' || (event_id % 4) AS batch_id FROM events)"""


@query(
    S.with_(
        _SOURCES,
        f"""SELECT dataset_name, version, {TS('ingest')} AS ingest_timestamp, batch_id FROM (SELECT *, row_number() OVER (
        PARTITION BY dataset_name ORDER BY ingest DESC, batch_id DESC, version DESC) AS place FROM versions) WHERE place = 1""",
    )
)
def dim_source(spark, folder):
    stage = W.table(spark, folder, "events").select(
        F.col("event_type").alias("dataset_name"),
        F.lit("stream").alias("collection_method"),
        F.concat(F.lit("v"), (F.col("user_id") % 3).cast("string")).alias("version"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("ingest_timestamp"),
        F.concat(F.lit("b"), (F.col("event_id") % 4).cast("string")).alias("batch_id"),
    )
    latest = star.dim_source(stage).select("dataset_name", "version", "ingest_timestamp", "batch_id")
    return as_text(latest, "ingest_timestamp")


_FACTS = """SELECT conversation_id, turn_number, prompt_hash, model_name, task_type, programming_lang, language,
  sha256(conversation_id) AS session_id, dataset_name, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') AS ts, tokens, response_tokens,
  quality_label, success_score FROM stage"""
_FACT_COLUMNS = (
    "conversation_id", "turn_number", "prompt_hash", "model_name", "task_type", "programming_lang", "language",
    "session_id", "dataset_name", "ts", "tokens", "response_tokens", "quality_label", "success_score",
)


def _dims(stage: DataFrame, battles: DataFrame | None = None) -> dict[str, DataFrame]:
    return {
        "dim_prompt": star.dim_prompt(stage),
        "dim_model": star.dim_model(stage),
        "dim_task": star.dim_task(stage),
        "dim_time": star.dim_time(stage),
        "dim_session": star.dim_session(stage),
        "dim_source": star.dim_source(stage),
    }


def _named_facts(facts: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Facts with their natural keys, through the dimensions."""
    joined = (
        facts.join(dims["dim_prompt"].select("prompt_key", "prompt_hash"), "prompt_key")
        .join(dims["dim_model"].select("model_key", "model_name"), "model_key", "left")
        .join(dims["dim_task"].select("task_key", "task_type", "programming_lang", "language"), "task_key", "left")
        .join(dims["dim_time"].select("time_key", "ts"), "time_key", "left")
        .join(dims["dim_session"].select("session_key", "session_id"), "session_key", "left")
        .join(dims["dim_source"].select("source_key", "dataset_name"), "source_key", "left")
    )
    return as_text(joined.select(*_FACT_COLUMNS), "ts")


@query(S.with_(S.STAGE, _FACTS))
def fact_prompt_execution(spark, folder):
    stage = stored(_stage(spark, folder), "stage")
    return _named_facts(star.execution_facts(stage), _dims(stage))


@query(S.with_(S.STAGE, _FACTS))
def fact_prompt_execution_by_lookup(spark, folder):
    stage = stored(_stage(spark, folder), "stage")
    dims = _dims(stage)
    return _named_facts(star.looked_up_execution_facts(stage, dims), dims)


_COMPARISON_FACTS = """SELECT conversation_id, prompt_hash, model_a, model_b,
  CASE lower(winner) WHEN 'model_a' THEN model_a WHEN 'model_b' THEN model_b END AS winner_model,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') AS ts, dataset_name FROM comparison_stage WHERE model_a <> '' AND model_b <> ''"""


def _named_comparisons(facts: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    names = dims["dim_model"].select("model_key", "model_name")
    joined = facts.join(dims["dim_prompt"].select("prompt_key", "prompt_hash"), "prompt_key")
    for role, column in (("model_a_key", "model_a"), ("model_b_key", "model_b"), ("winner_model_key", "winner_model")):
        side = names.select(F.col("model_key").alias(role), F.col("model_name").alias(column))
        joined = joined.join(side, role, "left")
    joined = joined.join(dims["dim_time"].select("time_key", "ts"), "time_key", "left")
    joined = joined.join(dims["dim_source"].select("source_key", "dataset_name"), "source_key", "left")
    columns = ("conversation_id", "prompt_hash", "model_a", "model_b", "winner_model", "ts", "dataset_name")
    return as_text(joined.select(*columns), "ts")


def _comparison_dims(stage: DataFrame) -> dict[str, DataFrame]:
    return {
        "dim_prompt": star.dim_prompt(stage),
        "dim_model": star.dim_model_of_comparisons(stage),
        "dim_time": star.dim_time(stage),
        "dim_source": star.dim_source(stage),
    }


@query(S.with_(S.COMPARISON_STAGE, _COMPARISON_FACTS))
def fact_model_comparison(spark, folder):
    stage = stored(W.comparison_stage(spark, folder), "stage")
    return _named_comparisons(star.comparison_facts(stage), _comparison_dims(stage))


@query(S.with_(S.COMPARISON_STAGE, _COMPARISON_FACTS))
def fact_model_comparison_by_lookup(spark, folder):
    stage = stored(W.comparison_stage(spark, folder), "stage")
    dims = _comparison_dims(stage)
    return _named_comparisons(star.looked_up_comparison_facts(stage, dims), dims)


@query(
    S.with_(
        S.STAGE + "," + S._after_docs(S.COMPARISON_STAGE).replace(S._after_docs(S.BATTLES) + ",", ""),
        """SELECT 'prompt' AS target, count(*) AS processed, count(*) AS loaded, 0::BIGINT AS rejected FROM stage
        UNION ALL SELECT 'comparison', count(*), count(*) FILTER (WHERE model_a <> '' AND model_b <> ''),
        count(*) FILTER (WHERE model_a = '' OR model_b = '') FROM comparison_stage""",
    )
)
def warehouse_load(spark, folder):
    """Records of all sources loaded into a persisted warehouse; the audit of both loads."""
    house = Warehouse(spark, new_folder(spark, "warehouse"))
    house.load(_stage(spark, folder), "prompt", load_name(1, "prompt"))
    house.load(W.comparison_stage(spark, folder), "comparison", load_name(1, "comparison"))
    return house.totals().select("target", "processed", "loaded", "rejected")


_TIES = "token_estimate, prompt_type, contains_code, contains_examples, contains_constraints"  # as in `dim_prompt`
_LATEST_PROMPTS = f"""
offered AS (
  SELECT 3 AS place, prompt_hash, prompt_length, prompt_text, {_TIES}, language FROM comparison_stage
  UNION ALL SELECT 2, prompt_hash, prompt_length, prompt_text, {_TIES}, language FROM stage
  UNION ALL SELECT 1, prompt_hash, prompt_length, prompt_text, {_TIES}, 'zz' FROM stage WHERE prompt_hash < '8')
SELECT prompt_hash, prompt_text, language FROM (SELECT *, row_number() OVER (
  PARTITION BY prompt_hash ORDER BY place, prompt_length DESC, prompt_text, {_TIES}, language) AS pick
  FROM offered) WHERE pick = 1"""


@query(
    S.with_(
        S.STAGE + "," + S._after_docs(S.COMPARISON_STAGE).replace(S._after_docs(S.BATTLES) + ",", "") + "," + _LATEST_PROMPTS, ""
    )
)
def dim_prompt_after_second_load(spark, folder):
    """Prompts of three loads, the latest of which wins: comparisons, merged and stored; prompts under a name that sorts
    below; the half of those prompts once more with another language.
    """
    house = Warehouse(spark, new_folder(spark, "warehouse"))
    house.load(W.comparison_stage(spark, folder), "comparison", load_name(2, "comparison"))
    house.snapshot("dim_prompt")
    (low, low_at), (high, high_at) = _stage_halves(spark, folder, F.col("prompt_hash") < "8")
    house.load(low.unionByName(high), "prompt", load_name(1, "prompt", 2))
    removed(spark, high_at)
    house.load(low.withColumn("language", F.lit("zz")), "prompt", load_name(1, "prompt", 1), consumed=low_at)
    return house.table("dim_prompt").select("prompt_hash", "prompt_text", "language")


def _loaded_late(spark, folder) -> Warehouse:
    """A warehouse whose rollups were refreshed before a load with rows of an earlier day came."""
    house = Warehouse(spark, new_folder(spark, "warehouse"))
    early = F.col("timestamp") < F.lit("2024-01-21").cast("timestamp")
    (early_rows, early_at), (other_rows, other_at) = _stage_halves(spark, folder, early)
    house.load(other_rows, "prompt", load_name(2, "prompt"), consumed=other_at)
    house.refresh_rollups()
    house.load(early_rows, "prompt", load_name(1, "prompt"), consumed=early_at)
    return house


@query(
    S.with_(
        S.STAGE,
        f"""SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, coalesce(model_name, 'unknown') AS model_name,
        count(*) AS attempts, round(avg(success_score), {S.R}) AS avg_success, median(success_score) AS median_success
        FROM stage WHERE success_score IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2""",
    )
)
def current_daily_after_late_load(spark, folder):
    """The daily rollup after a late load, without a refresh."""
    return rounded(day_text(_loaded_late(spark, folder).current_daily()), "avg_success")


@query(
    S.with_(
        S.STAGE,
        f"""SELECT model_name, count(*) AS attempts, round(avg(success_score), {S.R}) AS avg_success,
        median(success_score) AS median_success FROM stage
        WHERE dataset_name ILIKE '%arena%' AND success_score IS NOT NULL AND model_name <> '' GROUP BY 1""",
    )
)
def rollup_refresh(spark, folder):
    """The board of arena models after a second refresh, which covers the late load."""
    house = _loaded_late(spark, folder)
    house.refresh_rollups()
    return rounded(house.rollup("model_performance_arena"), "avg_success")


@query(
    S.with_(
        S.STAGE + """,
        tasks AS (SELECT DISTINCT task_type, language, programming_lang, task_category AS category, prompt_hash < '8' AS early FROM stage),
        first_load AS (SELECT * EXCLUDE (early) FROM tasks WHERE early)""",
        "SELECT 'first' AS load, * FROM first_load UNION ALL "
        "SELECT 'second', * FROM (SELECT * EXCLUDE (early) FROM tasks WHERE NOT early EXCEPT SELECT * FROM first_load)",
    )
)
def new_tasks(spark, folder):
    """Which tasks each of two loads has added to the dimension."""
    house = Warehouse(spark, new_folder(spark, "warehouse"))
    halves = _stage_halves(spark, folder, F.col("prompt_hash") < "8")
    for load, (rows, at) in zip(("first", "second"), halves, strict=True):
        house.load(rows.where("prompt_hash IS NOT NULL"), "prompt", load, consumed=at)
    return house.added("dim_task").select("load", "task_type", "language", "programming_lang", "category")


@query(
    S.with_(
        S.STAGE,
        """SELECT 'fact_promptexecution' AS "table", count(*) AS rows FROM stage
        UNION ALL SELECT 'fact_model_comparison', 0 UNION ALL SELECT 'dim_prompt', count(DISTINCT prompt_hash) FROM stage
        UNION ALL SELECT 'dim_model', count(DISTINCT model_name) FROM stage WHERE model_name <> ''
        UNION ALL SELECT 'dim_time', count(DISTINCT ts) FROM stage UNION ALL SELECT 'dim_session', count(DISTINCT conversation_id) FROM stage
        UNION ALL SELECT 'dim_source', count(DISTINCT dataset_name) FROM stage
        UNION ALL SELECT 'dim_task', count(*) FROM (SELECT DISTINCT task_type, language, programming_lang, task_category FROM stage)""",
    )
)
def entity_counts(spark, folder):
    """Rows of every table after two loads, of which one was replayed."""
    house = Warehouse(spark, new_folder(spark, "warehouse"))
    (low, low_at), (high, high_at) = _stage_halves(spark, folder, F.col("prompt_hash") < "8")
    house.load(low, "prompt", "a")
    house.load(high.where("prompt_hash IS NOT NULL"), "prompt", "b", consumed=high_at)
    house.load(low, "prompt", "a", consumed=low_at)
    return house.entity_counts()


# --- rollups -----------------------------------------------------------------------------------


def _star(spark, folder):
    return W.execution_star(spark, folder)


def _daily(spark, folder):
    facts = W.run_facts(spark, folder)
    return rollups.daily_model_success(facts, W.run_models(spark, folder))


def _arena(spark, folder):
    return rollups.arena_model_performance(
        W.run_facts(spark, folder), W.run_models(spark, folder), W.run_sources(spark, folder)
    )


def _languages(spark, folder):
    facts, tasks_ = W.prompt_facts(spark, folder)
    return rollups.language_performance(facts, tasks_)


def _impact(spark, folder):
    tables = _star(spark, folder)
    return rollups.feature_impact(tables["fact_promptexecution"], tables["dim_prompt"])


def _templates(spark, folder):
    tables = _star(spark, folder)
    return rollups.template_performance(tables["fact_promptexecution"], tables["dim_prompt"])


def _efficiency(spark, folder):
    return rollups.model_efficiency(W.run_facts(spark, folder), W.run_models(spark, folder))


DAY = "strftime(day, '%Y-%m-%d') AS day"


def day_text(df: DataFrame) -> DataFrame:
    return df.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(S.with_(S.DAILY, f"SELECT * REPLACE (strftime(day, '%Y-%m-%d') AS day, round(avg_success, {S.R}) AS avg_success) FROM daily"))
def daily_model_success(spark, folder):
    return rounded(day_text(_daily(spark, folder)), "avg_success")


@query(S.with_(S.ARENA_ROLLUP, f"SELECT * REPLACE (round(avg_success, {S.R}) AS avg_success) FROM arena_rollup"))
def arena_model_performance(spark, folder):
    return rounded(_arena(spark, folder), "avg_success")


@query(S.with_(S.LANGUAGE_ROLLUP, f"SELECT * REPLACE (round(success_rate, {S.R}) AS success_rate) FROM language_rollup"))
def language_performance(spark, folder):
    return rounded(_languages(spark, folder), "success_rate")


@query(S.with_(S.IMPACT, f"SELECT * REPLACE (round(avg_success, {S.R}) AS avg_success) FROM impact"))
def feature_impact(spark, folder):
    return rounded(_impact(spark, folder), "avg_success")


@query(S.with_(S.TEMPLATES, f"SELECT * REPLACE (round(avg_success, {S.R}) AS avg_success) FROM templates"))
def top_templates(spark, folder):
    return rounded(_templates(spark, folder), "avg_success")


_EFFICIENCY_MEANS = ("avg_latency", "avg_tokens", "avg_tokens_once", "avg_success_score")
_ROUND_EFFICIENCY = ", ".join(f"round({name}, 6) AS {name}" for name in _EFFICIENCY_MEANS)


@query(S.with_(S.EFFICIENCY, f"SELECT * REPLACE ({_ROUND_EFFICIENCY}) FROM efficiency"))
def model_efficiency(spark, folder):
    return rounded(_efficiency(spark, folder), *_EFFICIENCY_MEANS, digits=6)


# --- boards ------------------------------------------------------------------------------------


@query(S.with_(S.ARENA_ROLLUP + S.MODEL_BOARD, f"SELECT * REPLACE (round(avg_success, {S.R}) AS avg_success) FROM model_board"))
def model_board(spark, folder):
    return rounded(boards.model_board(_arena(spark, folder)), "avg_success")


@query(S.with_(S.LANGUAGE_ROLLUP + S.LANGUAGE_BOARD, f"SELECT * REPLACE (round(success_rate, {S.R}) AS success_rate) FROM language_board"))
def language_board(spark, folder):
    return rounded(boards.language_board(_languages(spark, folder)), "success_rate")


@query(S.with_(S.FEATURE_BOARD, f"SELECT * REPLACE (round(avg_success, {S.R}) AS avg_success) FROM feature_board"))
def feature_board(spark, folder):
    return rounded(boards.feature_board(_impact(spark, folder)), "avg_success")


@query(
    S.with_(
        S.FEATURE_BOARD,
        """SELECT (SELECT combination FROM feature_board ORDER BY avg_success DESC, position LIMIT 1) AS best_combination,
        (SELECT combination FROM feature_board ORDER BY avg_success, position DESC LIMIT 1) AS worst_combination,
        CASE WHEN (SELECT sample_count FROM feature_board ORDER BY avg_success DESC, position LIMIT 1) >= 100
          THEN 'medium' ELSE 'low' END AS confidence""",
    )
)
def feature_insights(spark, folder):
    return boards.feature_insights(boards.feature_board(_impact(spark, folder)))


@query(
    S.with_(
        S.TEMPLATES,
        f"""SELECT prompt_hash, substring(prompt_text, 1, 160) AS prompt_preview, length(prompt_text) > 0 AS full_prompt_available,
        uses AS usage_count, round(avg_success, {S.R}) AS avg_success, median_success, round(avg_success * 100, 2) AS success_rate_pct,
        CAST(row_number() OVER (ORDER BY avg_success DESC, uses DESC, prompt_hash) AS INTEGER) AS rank
        FROM templates WHERE uses >= 5 ORDER BY rank LIMIT 10""",
    )
)
def template_board(spark, folder):
    return rounded(boards.template_board(_templates(spark, folder)), "avg_success")


@query(S.with_(S.TEMPLATES, "SELECT count(*) AS total_templates FROM templates WHERE uses >= 5"))
def template_count(spark, folder):
    return boards.template_count(_templates(spark, folder))


_TIMELINE = S.DAILY + """,
recent AS (SELECT * FROM daily WHERE day >= DATE '2024-01-30' - INTERVAL 10 DAY)"""


@query(S.with_(_TIMELINE, f"SELECT * REPLACE (strftime(day, '%Y-%m-%d') AS day, round(avg_success, {S.R}) AS avg_success) FROM recent WHERE model_name = 'm3'"))
def timeline_of_model(spark, folder):
    rows = boards.timeline(_daily(spark, folder), as_of=AS_OF, days=10, model="m3")
    return rounded(day_text(rows), "avg_success")


@query(
    S.with_(
        S.DAILY,
        f"""SELECT * REPLACE (strftime(day, '%Y-%m-%d') AS day, round(avg_success, {S.R}) AS avg_success) FROM daily
        WHERE day BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'""",
    )
)
def timeline_of_range(spark, folder):
    rows = boards.timeline(_daily(spark, folder), start=dt.date(2024, 1, 5), end=dt.date(2024, 1, 9))
    return rounded(day_text(rows), "avg_success")


@query(
    S.with_(
        _TIMELINE,
        """SELECT strftime(day, '%Y-%m-%d') AS day, string_agg(model_name || ':' || attempts || ':' || CAST(median_success AS VARCHAR),
        ' ' ORDER BY model_name) AS series FROM recent GROUP BY 1""",
    )
)
def timeline_nested(spark, folder):
    nested = boards.timeline_nested(boards.timeline(_daily(spark, folder), as_of=AS_OF, days=10))
    point = F.transform("series", lambda p: F.concat_ws(":", p["model_name"], p["attempts"], p["median_success"]))
    return day_text(nested).select("day", F.array_join(point, " ").alias("series"))


@query(
    S.with_(
        _TIMELINE,
        """SELECT string_agg(DISTINCT model_name, ',' ORDER BY model_name) AS models, strftime(min(day), '%Y-%m-%d') AS "start",
        strftime(max(day), '%Y-%m-%d') AS "end" FROM recent""",
    )
)
def timeline_scope(spark, folder):
    scope = boards.timeline_scope(boards.timeline(_daily(spark, folder), as_of=AS_OF, days=10))
    return scope.select(
        F.array_join("models", ",").alias("models"),
        F.date_format("start", "yyyy-MM-dd").alias("start"),
        F.date_format("end", "yyyy-MM-dd").alias("end"),
    )


@query(
    S.with_(
        S.DAILY,
        "SELECT strftime(day, '%Y-%m-%d') AS day, "
        + ", ".join(f"round(max(CASE WHEN model_name = '{m}' THEN avg_success * 100 END), {S.R}) AS {m}" for m in [*MODELS, "unknown"])
        + " FROM daily GROUP BY 1",
    )
)
def timeline_pivot(spark, folder):
    names = [*MODELS, "unknown"]
    return rounded(day_text(boards.timeline_pivot(_daily(spark, folder), names)), *names)


@query(
    S.with_(
        S.EFFICIENCY,
        f"""SELECT * REPLACE ({_ROUND_EFFICIENCY}), CAST(row_number() OVER (ORDER BY coalesce(avg_success_score, 0) DESC,
        avg_latency ASC NULLS LAST, model_name) AS INTEGER) AS position FROM efficiency ORDER BY position LIMIT 12""",
    )
)
def efficiency_board(spark, folder):
    return rounded(boards.efficiency_board(_efficiency(spark, folder), 12), *_EFFICIENCY_MEANS, digits=6)


@query(
    S.with_(
        S.FEATURE_BOARD.replace(S.RUNS, S.ARENA_ROLLUP, 1).replace(S.PROMPTS, S.LANGUAGE_ROLLUP, 1) + S.MODEL_BOARD + S.LANGUAGE_BOARD,
        """SELECT (SELECT CAST(sum(attempts) AS BIGINT) FROM model_board) AS total_attempts,
        (SELECT count(*) FROM model_board) AS tracked_models,
        (SELECT round(avg(success_rate_pct), 1) FROM model_board) AS system_success_pct,
        (SELECT model_name FROM model_board ORDER BY success_rate_pct DESC, rank LIMIT 1) AS top_model,
        (SELECT programming_language FROM language_board ORDER BY success_rate, position LIMIT 1) AS hardest_language,
        (SELECT count(*) FROM feature_board) AS feature_combos""",
    )
)
def dashboard_kpis(spark, folder):
    return boards.dashboard_kpis(
        boards.model_board(_arena(spark, folder)),
        boards.language_board(_languages(spark, folder)),
        boards.feature_board(_impact(spark, folder)),
    )


@query(
    S.with_(
        S.DAILY,
        f"SELECT * REPLACE (strftime(day, '%Y-%m-%d') AS day, round(avg_success, {S.R}) AS avg_success) FROM (SELECT * FROM daily ORDER BY day DESC, model_name LIMIT 30)",
    )
)
def latest_daily_rows(spark, folder):
    return rounded(day_text(boards.latest_days(_daily(spark, folder))), "avg_success")


@query(
    S.with_(
        S.ARENA_ROLLUP,
        "SELECT model_name, attempts FROM arena_rollup WHERE attempts > 1 ORDER BY attempts DESC, model_name LIMIT 50",
    )
)
def adhoc_select(spark, folder):
    statement = "SELECT model_name, attempts FROM model_performance_arena WHERE attempts > 1 ORDER BY attempts DESC, model_name"
    return boards.adhoc(spark, {"model_performance_arena": _arena(spark, folder)}, statement)


# --- exploration -------------------------------------------------------------------------------


@query(
    S.with_(
        S.PROMPTS,
        "SELECT language, round(avg(success_score), 9) AS avg_success, count(*) AS sample_size FROM prompts "
        "WHERE success_score IS NOT NULL GROUP BY 1 HAVING count(*) > 50",
    )
)
def language_success(spark, folder):
    scored = W.prompts(spark, folder).where(F.col("success_score").isNotNull())
    return rounded(eda.language_success(scored), "avg_success")


_CORRELATED = ("prompt_length", "token_estimate", "complexity_score", "instruction_density", "success_score", "tokens")


@query(
    S.with_(
        S.PROMPTS,
        " UNION ALL ".join(
            f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 6) AS r FROM prompts WHERE success_score IS NOT NULL"
            for x in _CORRELATED
            for y in _CORRELATED
        ),
    )
)
def feature_correlation(spark, folder):
    return rounded(eda.correlation_matrix(W.prompts(spark, folder), list(_CORRELATED)), "r", digits=6)


@query(
    S.with_(
        S.PROMPTS,
        """SELECT contains_code, CAST(floor(success_score / 0.25) AS BIGINT) AS bin, count(*) AS n,
        round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY contains_code) AS DOUBLE) / 0.25, 9) AS density
        FROM prompts WHERE success_score IS NOT NULL GROUP BY 1, 2""",
    )
)
def score_density(spark, folder):
    return rounded(eda.score_density(W.prompts(spark, folder), "contains_code", width=0.25), "density")


@query(
    S.with_(
        S.RUNS,
        """SELECT count(*) AS total_records, count(*) - count(latency) AS missing, round(avg(latency), 6) AS mean,
        round(stddev_samp(latency), 6) AS std, min(latency) AS min, max(latency) AS max,
        round(quantile_cont(latency, 0.5), 9) AS median FROM runs""",
    )
)
def target_summary(spark, folder):
    summary = eda.target_summary(W.executions(spark, folder), "latency")
    return rounded(rounded(summary, "mean", "std", digits=6), "median")


@query(
    S.with_(
        S.RUNS,
        """SELECT round(quantile_cont(latency, 0.5), 9) AS median, round(quantile_cont(latency, 0.75), 9) AS q75,
        round(quantile_cont(latency, 0.99), 9) AS q99 FROM runs""",
    )
)
def latency_quantiles(spark, folder):
    runs = W.executions(spark, folder)
    values = ordered.exact_quantiles(runs, {"latency": [0.5, 0.75, 0.99]})["latency"]
    return runs.limit(1).select(*[F.round(F.lit(v), S.R).alias(n) for v, n in zip(values, ("median", "q75", "q99"))])


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", '{kind}' AS type, true AS nullable, count(*) AS rows, count(*) - count({name}) AS missing FROM documents"
        for name, kind in (("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"))
    )
)
def table_profile(spark, folder):
    return raw.profile(W.table(spark, folder, "documents"))


@query()
def file_inventory(spark, folder):
    """Files of the data folder with readable sizes."""
    return raw.inventory(spark, folder)


@query(
    S.with_(
        S.RUNS + "," + S.PROMPT_DIM,
        f"""SELECT r.execution_key, {', '.join('p.' + c for c in eda.EXTRACT if c not in ('success_score', 'tokens', 'response_tokens'))},
        r.success_score, r.tokens, r.response_tokens, CAST(r.success_score >= 0.5 AS INTEGER) AS is_successful
        FROM run_prompts r JOIN prompt_dim p USING (prompt_hash) WHERE r.success_score IS NOT NULL""",
    )
)
def eda_extract(spark, folder):
    tables = W.full_star(spark, folder)
    return eda.eda_extract(tables["fact_promptexecution"], tables["dim_prompt"], ("execution_key",))


# --- training ----------------------------------------------------------------------------------


def _extract(spark, folder):
    """Scored executions with those of their prompt's features that cleaning and the text columns read; the features are
    stored by prompt, so that none is made once more for each of its executions.
    """
    runs = W.executions(spark, folder).where(F.col("success_score").isNotNull())
    unused = (
        "success_score", "tokens", "response_tokens", "response_text", "prompt_text", "prompt_hash", "programming_lang", "complexity_score",
        "contains_code", "contains_examples", "contains_constraints", "example_count", "constraint_count", "length", "type",
    )
    docs = training.with_training_features(W.prompts(spark, folder)).drop(*unused)
    renamed = runs.withColumnsRenamed({"success_score": "success_rate", "latency": "latency_ms", "tokens": "tokens_used"})
    extra = {"attempt_count": F.lit(1), "task_type": F.lit(None).cast("string")}
    return renamed.drop("response_tokens").join(stored(docs, "prompt-features"), "doc_id").withColumns(extra)


_EXTRACTED = ("prompt_length", "token_estimate", "prompt_type", "language", "contains_code", "complexity_score", "instruction_density")


@query(
    S.with_(
        S.STAGE + """,
        variants AS (SELECT *, row_number() OVER (PARTITION BY prompt_hash ORDER BY prompt_length DESC, prompt_text, token_estimate,
          prompt_type, contains_code, contains_examples, contains_constraints, language, complexity_score, instruction_density) AS place
          FROM stage)""",
        f"""SELECT s.conversation_id, s.turn_number, s.prompt_hash AS prompt_key, s.model_name, s.task_type,
        CASE WHEN s.success_score >= 0.5 THEN 'success' ELSE 'failure' END AS execution_status, s.tokens AS tokens_used,
        s.success_score AS success_rate, 1 AS attempt_count, {', '.join('d.' + c for c in _EXTRACTED)},
        {S.words(S.norm('d.prompt_text'))} AS prompt_word_count,
        length(d.prompt_text) - length(replace(d.prompt_text, '?', '')) AS question_marks
        FROM stage s LEFT JOIN variants d ON d.prompt_hash = s.prompt_hash AND d.place = 1 WHERE s.success_score IS NOT NULL""",
    )
)
def training_extract(spark, folder):
    stage = stored(_stage(spark, folder), "stage")
    prompts = training.with_training_features(star.dim_prompt(stage)).drop("prompt_text")
    wide = star.training_extract(star.execution_facts(stage), prompts, star.dim_model(stage), star.dim_task(stage))
    counts = {name: F.col(name).cast("bigint") for name in ("prompt_word_count", "question_marks")}
    return wide.withColumns(counts).select(
        "conversation_id", "turn_number", "prompt_key", "model_name", "task_type", "execution_status", "tokens_used",
        "success_rate", "attempt_count", *_EXTRACTED, "prompt_word_count", "question_marks",
    )


@query(
    S.with_(
        S.RUNS + "," + S.PROMPT_DIM + """,
        filled AS (
          SELECT r.execution_key, r.k, p.prompt_text, coalesce(r.latency, 100.0) AS latency_ms, r.success_score AS success_rate
          FROM runs r JOIN prompts p ON p.doc_id = r.doc_id WHERE r.success_score IS NOT NULL),
        limits AS (SELECT quantile_cont(latency_ms, 0.99) AS most FROM filled)""",
        f"""SELECT execution_key, latency_ms, k AS tokens_used, success_rate, {S.words(S.norm('prompt_text'))} AS prompt_word_count,
        round(length(replace(prompt_text, ' ', '')) / CAST({S.words(S.norm('prompt_text'))} + 1 AS DOUBLE), 9) AS avg_word_length,
        length(prompt_text) - length(replace(prompt_text, '?', '')) AS question_marks,
        {S.count('prompt_text', '```|<code>')} AS code_blocks, {S.count('prompt_text', chr(92) + 'n-|' + chr(92) + 'n' + chr(92) + 'd+' + chr(92) + '.')} AS list_items,
        round({S.count('prompt_text', '[A-Z]')} / CAST(length(prompt_text) + 1 AS DOUBLE), 9) AS capital_ratio
        FROM filled, limits WHERE latency_ms <= most AND k > 0""",
    )
)
def training_features(spark, folder):
    wide = training.clean_training(_extract(spark, folder))
    counts = {name: F.col(name).cast("bigint") for name in ("prompt_word_count", "question_marks")}
    columns = (
        "execution_key", "latency_ms", "tokens_used", "success_rate", "prompt_word_count", "avg_word_length",
        "question_marks", "code_blocks", "list_items", "capital_ratio",
    )
    return rounded(wide.withColumns(counts).select(*columns), "avg_word_length", "capital_ratio")


@query(
    S.with_(
        S.RUNS,
        """SELECT split, n FROM (SELECT count(*) AS total FROM runs), LATERAL (VALUES
        ('train', CAST(ceil(round(total * 0.70, 6)) AS BIGINT)),
        ('val', CAST(ceil(round(total * 0.85, 6)) - ceil(round(total * 0.70, 6)) AS BIGINT)),
        ('test', CAST(total - ceil(round(total * 0.85, 6)) AS BIGINT))) AS v(split, n)""",
    )
)
def train_split_counts(spark, folder):
    split = training.train_val_test(W.executions(spark, folder).select("execution_key"))
    return split.groupBy("split").agg(F.count("*").alias("n"))


@query(
    S.with_(
        S.RUNS,
        """SELECT label, split, n FROM (SELECT CAST(success_score >= 0.5 AS INTEGER) AS label, count(*) AS total FROM runs
        WHERE success_score IS NOT NULL GROUP BY 1), LATERAL (VALUES ('train', CAST(ceil(round(total * 0.8, 6)) AS BIGINT)),
        ('test', CAST(total - ceil(round(total * 0.8, 6)) AS BIGINT))) AS v(split, n)""",
    )
)
def stratified_split_counts(spark, folder):
    scored = W.executions(spark, folder).where(F.col("success_score").isNotNull())
    labelled = scored.select("execution_key", (F.col("success_score") >= 0.5).cast("int").alias("label"))
    split = training.stratified_train_test(labelled, "label")
    return split.groupBy("label", "split").agg(F.count("*").alias("n"))


_SHARES = {"train": 0.70, "val": 0.15, "test": 0.15}


@query(S.with_(S.RUNS, S.split("runs", "execution_key", _SHARES, "execution_key")))
def train_split(spark, folder):
    return training.train_val_test(W.executions(spark, folder).select("execution_key"))


@query(
    S.with_(
        S.RUNS + """,
        labelled AS (SELECT execution_key, CAST(success_score >= 0.5 AS INTEGER) AS label FROM runs WHERE success_score IS NOT NULL)""",
        S.split("labelled", "execution_key", {"train": 0.8, "test": 0.2}, "execution_key, label", "label"),
    )
)
def stratified_split(spark, folder):
    scored = W.executions(spark, folder).where(F.col("success_score").isNotNull())
    labelled = scored.select("execution_key", (F.col("success_score") >= 0.5).cast("int").alias("label"))
    return training.stratified_train_test(labelled, "label")


@query(
    S.with_(
        S.RUNS,
        f"""SELECT execution_key, {TS('ts')} AS timestamp, doc_id, model_name, dataset_name, latency, tokens, response_tokens,
        success_score FROM (SELECT * FROM runs ORDER BY {S.hash_order('execution_key')}, execution_key LIMIT 25000)""",
    )
)
def random_sample(spark, folder):
    """25,000 reproducibly random executions (all of them, if there are fewer)."""
    return as_text(star.random_rows(W.executions(spark, folder), "execution_key"), "timestamp")


@query(
    S.with_(
        S.RUNS,
        f"SELECT execution_key, {TS('ts')} AS timestamp FROM (SELECT execution_key, ts FROM runs ORDER BY ts DESC, execution_key DESC LIMIT 1000)",
    )
)
def newest_executions(spark, folder):
    newest = star.newest(W.executions(spark, folder), "timestamp", "execution_key", 1000)
    return as_text(newest.select("execution_key", "timestamp"), "timestamp")


# --- mining ------------------------------------------------------------------------------------


def _minable(spark, folder):
    prompts = W.prompts(spark, folder).where(F.col("success_score").isNotNull())
    featured = training.with_training_features(prompts).drop("prompt_text", "response_text")
    return stored(featured.withColumnsRenamed({"success_score": "success_rate", "tokens": "tokens_used"}), "features")


_ITEMS = S.PROMPTS + """,
scored AS (SELECT * FROM prompts WHERE success_score IS NOT NULL),
marks AS (SELECT quantile_cont(prompt_length, 0.75) AS l, quantile_cont(token_estimate, 0.75) AS t, quantile_cont(tokens, 0.75) AS u,
  quantile_cont(instruction_density, 0.5) AS d, quantile_cont(complexity_score, 0.5) AS c FROM scored),
baskets AS (
  SELECT list_sort(list_filter([CASE WHEN contains_code THEN 'contains_code=1' END,
    CASE WHEN contains_examples THEN 'contains_examples=1' END, CASE WHEN contains_constraints THEN 'contains_constraints=1' END,
    'language_' || language || '=1', CASE WHEN prompt_length > l THEN 'prompt_length_high' END,
    CASE WHEN token_estimate > t THEN 'token_estimate_high' END, CASE WHEN tokens > u THEN 'tokens_used_high' END,
    CASE WHEN instruction_density > d THEN 'instruction_density_high' END,
    CASE WHEN complexity_score > c THEN 'complexity_score_high' END, CASE WHEN success_score > 0.5 THEN 'success_high' END],
    lambda x: x IS NOT NULL)) AS items FROM scored, marks)"""
_SETS = _ITEMS + """,
masks AS (SELECT items, unnest(range(1, CAST(1 AS BIGINT) << len(items))) AS mask FROM baskets),
picked AS (SELECT list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS items FROM masks),
sets AS (SELECT items, count(*) AS freq, count(*) / CAST((SELECT count(*) FROM baskets) AS DOUBLE) AS support FROM picked
  GROUP BY 1 HAVING count(*) / CAST((SELECT count(*) FROM baskets) AS DOUBLE) >= 0.08)"""
_RULES = _SETS + """,
splits AS (
  SELECT s.items, s.support, a.items AS antecedents, a.support AS sa FROM sets s JOIN sets a
    ON len(a.items) < len(s.items) AND list_has_all(s.items, a.items)),
rules AS (
  SELECT antecedents, c.items AS consequents, s.support, s.support / sa AS confidence, s.support / sa / c.support AS lift,
    s.support - sa * c.support AS leverage,
    CASE WHEN s.support / sa < 1 THEN (1 - c.support) / (1 - s.support / sa) END AS conviction
  FROM splits s JOIN sets c ON c.items = list_filter(s.items, lambda x: NOT list_contains(s.antecedents, x))),
kept AS (SELECT * FROM rules WHERE confidence >= 0.5 AND lift >= 2.0)"""
_MEASURES = ("support", "confidence", "lift", "leverage", "conviction")
_RULE_SELECT = (
    "SELECT array_to_string(antecedents, ', ') AS antecedents, array_to_string(consequents, ', ') AS consequents, "
    + ", ".join(f"round({m}, 9) AS {m}" for m in _MEASURES)
)


def _baskets(spark, folder):
    return mining.transactions(_minable(spark, folder), categories=("language",))


def _rules(spark, folder):
    return mining.association_rules(mining.frequent_itemsets(_baskets(spark, folder)))


def _flat_rules(rules: DataFrame) -> DataFrame:
    sides = {side: F.array_join(side, ", ") for side in ("antecedents", "consequents")}
    return rounded(rules.withColumns(sides), *_MEASURES)


@query(S.with_(_ITEMS, "SELECT array_to_string(items, ',') AS items FROM baskets"))
def transactions(spark, folder):
    return _baskets(spark, folder).select(F.array_join("items", ",").alias("items"))


def _words_of_texts(spark, folder):
    """A basket of distinct words per document."""
    words = F.array_remove(F.split(F.lower("text"), " "), "")
    return W.text_table(spark, folder, "documents", "doc_id").select(F.array_distinct(words).alias("items"))


_WORD_SETS = """
words AS (SELECT doc_id, unnest(list_distinct(list_filter(string_split(lower(text), ' '), lambda w: w <> ''))) AS w FROM documents),
n AS (SELECT count(*) AS n FROM documents),
known AS (SELECT w FROM words GROUP BY w HAVING count(*) / (SELECT n FROM n) >= 0.3),
baskets AS (SELECT doc_id, w FROM words SEMI JOIN known USING (w)),
sets AS (SELECT w AS items, count(*) AS freq FROM baskets GROUP BY ALL
  UNION ALL SELECT a.w || ' ' || b.w, count(*) FROM baskets a JOIN baskets b ON a.doc_id = b.doc_id AND a.w < b.w GROUP BY ALL
  UNION ALL SELECT a.w || ' ' || b.w || ' ' || c.w, count(*) FROM baskets a JOIN baskets b ON a.doc_id = b.doc_id AND a.w < b.w
    JOIN baskets c ON b.doc_id = c.doc_id AND b.w < c.w GROUP BY ALL
  UNION ALL SELECT a.w || ' ' || b.w || ' ' || c.w || ' ' || d.w, count(*) FROM baskets a JOIN baskets b ON a.doc_id = b.doc_id AND a.w < b.w
    JOIN baskets c ON b.doc_id = c.doc_id AND b.w < c.w JOIN baskets d ON c.doc_id = d.doc_id AND c.w < d.w GROUP BY ALL)"""


@query(S.with_(_WORD_SETS, f"SELECT items, freq, round(freq / n, {S.R}) AS support FROM sets, n WHERE freq / n >= 0.3"))
def word_sets(spark, folder):
    """Up to four words that 30 % of the documents share: baskets of hundreds of items, of which dozens are frequent."""
    sets = mining.frequent_itemsets(_words_of_texts(spark, folder), 0.3, longest=4)
    return rounded(sets.withColumn("items", F.array_join("items", " ")), "support")


@query(S.with_(_SETS, "SELECT array_to_string(items, ',') AS items, freq, round(support, 9) AS support FROM sets"))
def frequent_itemsets(spark, folder):
    sets = mining.frequent_itemsets(_baskets(spark, folder))
    return rounded(sets.withColumn("items", F.array_join("items", ",")), "support")


@query(S.with_(_RULES, _RULE_SELECT + " FROM kept"))
def association_rules(spark, folder):
    return _flat_rules(_rules(spark, folder))


_PLACED = _RULES + """,
placed AS (SELECT *, row_number() OVER (ORDER BY round(lift, 9) DESC, round(confidence, 9) DESC,
  array_to_string(antecedents, ', '), array_to_string(consequents, ', ')) AS place FROM kept)"""
_STATS = "count(*) AS rules, " + ", ".join(f"round(avg({m}), 6) AS avg_{m}" for m in ("confidence", "lift", "support"))


@query(S.with_(_PLACED, f"SELECT 'all' AS scope, {_STATS} FROM placed UNION ALL SELECT 'top', {_STATS} FROM placed WHERE place <= 50"))
def rule_stats(spark, folder):
    return rounded(mining.rule_stats(_rules(spark, folder)), "avg_confidence", "avg_lift", "avg_support", digits=6)


@query(S.with_(_PLACED, _RULE_SELECT + ", round(avg(confidence) OVER (), 9) AS avg_confidence FROM placed WHERE place <= 20"))
def top_rules(spark, folder):
    """The 20 best rules with the mean confidence of the page."""
    return rounded(mining.rule_lookup(_rules(spark, folder)), *_MEASURES, "avg_confidence")


_CATEGORICAL = S.PROMPTS + """,
rows_ AS (SELECT list_sort(['contains_code=' || contains_code, 'contains_examples=' || contains_examples,
    'contains_constraints=' || contains_constraints,
    'is_successful=' || CASE WHEN success_score >= 0.5 THEN 'Success' ELSE 'Failure' END]) AS items
  FROM prompts WHERE success_score IS NOT NULL),
picked AS (SELECT list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS items
  FROM (SELECT items, unnest(range(1, 16)) AS mask FROM rows_)),
sets AS (SELECT items, count(*) / CAST((SELECT count(*) FROM rows_) AS DOUBLE) AS support FROM picked GROUP BY 1
  HAVING count(*) / CAST((SELECT count(*) FROM rows_) AS DOUBLE) >= 0.05),
rules AS (
  SELECT coalesce(a.items, []) AS antecedents, c.items AS consequents, s.support, coalesce(a.support, 1.0) AS sa, c.support AS sc
  FROM sets s JOIN sets c ON len(c.items) = 1 AND list_has_all(s.items, c.items)
  LEFT JOIN sets a ON len(s.items) > 1 AND a.items = list_filter(s.items, lambda x: x <> c.items[1])
  WHERE len(s.items) = 1 OR a.items IS NOT NULL)"""


@query(
    S.with_(
        _CATEGORICAL,
        """SELECT array_to_string(antecedents, ', ') AS antecedents, array_to_string(consequents, ', ') AS consequents,
        round(support, 9) AS support, round(support / sa, 9) AS confidence, round(support / sa / sc, 9) AS lift FROM rules
        WHERE support / sa >= 0.6""",
    )
)
def categorical_rules(spark, folder):
    scored = W.prompts(spark, folder).where(F.col("success_score").isNotNull())
    named = scored.withColumn("is_successful", F.when(F.col("success_score") >= 0.5, "Success").otherwise("Failure"))
    columns = ["contains_code", "contains_examples", "contains_constraints", "is_successful"]
    return _flat_rules(mining.categorical_rules(named, columns)).drop("leverage", "conviction")


# --- evaluation --------------------------------------------------------------------------------

_PREDICTED = S.RUNS + """,
predicted AS (
  SELECT execution_key, success_score AS y, least(latency / 400.0, 1.0) AS p, (k % 7) / 8.0 AS q,
    CAST(success_score >= 0.5 AS INTEGER) AS label FROM runs WHERE success_score IS NOT NULL AND latency IS NOT NULL)"""


def _predicted(spark, folder):
    """Scored executions with two made-up predictions."""
    runs = W.executions(spark, folder).where(F.col("success_score").isNotNull() & F.col("latency").isNotNull())
    return runs.select(
        "execution_key",
        F.col("success_score").alias("y"),
        F.least(F.col("latency") / 400.0, F.lit(1.0)).alias("p"),
        ((F.col("tokens") % 7) / 8.0).alias("q"),
        (F.col("success_score") >= 0.5).cast("int").alias("label"),
    )


@query(
    S.with_(
        _PREDICTED,
        " UNION ALL ".join(
            f"""SELECT '{m}' AS model, count(*) AS n, round(avg(abs(y - {m})), 6) AS mae, round(sqrt(avg((y - {m}) * (y - {m}))), 6) AS rmse,
            round(1 - avg((y - {m}) * (y - {m})) / var_pop(y), 6) AS r2 FROM (SELECT *, 0.6 * p + 0.4 * q AS mix FROM predicted)"""
            for m in ("p", "q", "mix")
        ),
    )
)
def regression_metrics(spark, folder):
    mixed = _predicted(spark, folder).withColumn("mix", 0.6 * F.col("p") + 0.4 * F.col("q"))
    metrics = evaluation.regression_metrics(mixed, {"p": "p", "q": "q", "mix": "mix"}, "y")
    return rounded(metrics, "mae", "rmse", "r2", digits=6)


_RATES = (
    "accuracy", "no_information_rate", "kappa", "mcnemar_chi2", "sensitivity", "specificity", "pos_pred_value",
    "neg_pred_value", "prevalence", "detection_rate", "detection_prevalence", "balanced_accuracy",
)


_CELLS = _PREDICTED + """,
  cells AS (SELECT count(*) FILTER (WHERE q <= 0.5 AND label = 0) AS tp, count(*) FILTER (WHERE q <= 0.5 AND label = 1) AS fp,
    count(*) FILTER (WHERE q > 0.5 AND label = 0) AS fn, count(*) FILTER (WHERE q > 0.5 AND label = 1) AS tn, count(*) AS n FROM predicted),
  r AS (SELECT *, (tp + tn) / n AS acc, (tp + fn) / n AS prev, (tp + fp) / n AS det, tp / (tp + fn) AS sens, tn / (tn + fp) AS spec FROM cells)"""


@query(
    S.with_(
        _CELLS,
        """SELECT tp, fp, fn, tn, n, round(acc, 9) AS accuracy, round(greatest(prev, 1 - prev), 9) AS no_information_rate,
        round((acc - (prev * det + (1 - prev) * (1 - det))) / (1 - (prev * det + (1 - prev) * (1 - det))), 9) AS kappa,
        round(power(abs(fp - fn) - 1, 2) / (fp + fn), 9) AS mcnemar_chi2, round(sens, 9) AS sensitivity, round(spec, 9) AS specificity,
        round(tp / (tp + fp), 9) AS pos_pred_value, round(tn / (tn + fn), 9) AS neg_pred_value, round(prev, 9) AS prevalence,
        round(tp / n, 9) AS detection_rate, round(det, 9) AS detection_prevalence, round((sens + spec) / 2, 9) AS balanced_accuracy FROM r""",
    )
)
def confusion_metrics(spark, folder):
    classed = _predicted(spark, folder).withColumn("predicted", (F.col("q") > 0.5).cast("int"))
    counts = evaluation.confusion_counts(classed, "predicted", "label")
    return rounded(evaluation.confusion_metrics(counts), *_RATES)


def _upper_tail(hits: str, p: str) -> str:
    """Probability of at least `hits` of n successes of probability p, summed term by term."""
    term = f"lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln({p}) + (n - k) * ln(1 - {p})"
    return f"(SELECT sum(exp({term})) FROM hits, range({hits}, n + 1) AS t(k))"


def _bisection(name: str, hits: str, share: float) -> str:
    """The p at which the upper tail reaches a share, after 45 halvings."""
    return f"""{name} AS (SELECT CAST(0 AS DOUBLE) AS low, CAST(1 AS DOUBLE) AS high, 0 AS i UNION ALL
      SELECT CASE WHEN t < {share} THEN (low + high) / 2 ELSE low END, CASE WHEN t < {share} THEN high ELSE (low + high) / 2 END, i + 1
      FROM (SELECT low, high, i, {_upper_tail(hits, '((low + high) / 2)')} AS t FROM {name} WHERE i < 45))"""


_TESTS = ("accuracy_low", "accuracy_high", "accuracy_p_value", "mcnemar_p_value")


@query(
    "WITH RECURSIVE " + _CELLS.strip() + f""",
    hits AS (SELECT CAST(tp + tn AS BIGINT) AS h, CAST(n AS BIGINT) AS n FROM r),
    {_bisection('lows', 'h', 0.025)}, {_bisection('highs', 'h + 1', 0.975)},
    z AS (SELECT sqrt(power(abs(fp - fn) - 1, 2) / (fp + fn)) AS z, greatest(prev, 1 - prev) AS rate FROM r)
    SELECT tp, fp, fn, tn, n, (SELECT round(low, 6) FROM lows WHERE i = 45) AS accuracy_low,
      (SELECT round(low, 6) FROM highs WHERE i = 45) AS accuracy_high,
      round(coalesce({_upper_tail('h', 'rate')}, 0), 6) AS accuracy_p_value,
      (SELECT round(greatest(1 - 2 * sum(z / 20000 * exp(-power(z * (k + 0.5) / 20000, 2) / 2) / sqrt(2 * pi())), 0), 6)
       FROM range(0, 20000) AS t(k)) AS mcnemar_p_value FROM r, z"""
)
def confusion_tests(spark, folder):
    """The exact interval of the accuracy and the tests."""
    classed = _predicted(spark, folder).withColumn("predicted", (F.col("q") > 0.5).cast("int"))
    counts = evaluation.confusion_counts(classed, "predicted", "label")
    tested = evaluation.confusion_tests(evaluation.confusion_metrics(counts))
    return rounded(tested.select("tp", "fp", "fn", "tn", "n", *_TESTS), *_TESTS, digits=6)


_ROC = _PREDICTED + """,
points AS (
  SELECT p AS threshold, sum(label) AS pos, sum(1 - label) AS neg FROM predicted GROUP BY 1),
curve AS (
  SELECT threshold, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg
  FROM points WINDOW w AS (ORDER BY threshold DESC))"""


@query(
    S.with_(
        _ROC,
        "SELECT round(threshold, 9) AS threshold, round(tp / all_pos, 9) AS tpr, round(fp / all_neg, 9) AS fpr FROM curve",
    )
)
def roc_points(spark, folder):
    return rounded(evaluation.roc_points(_predicted(spark, folder), "p", "label").drop("area"), "threshold", "tpr", "fpr")


@query(
    S.with_(
        _ROC,
        "SELECT round(ln((threshold + 0.001) / (1.001 - threshold)), 6) AS threshold, round(tp / all_pos, 9) AS tpr, "
        "round(fp / all_neg, 9) AS fpr FROM curve",
    )
)
def roc_of_logits(spark, folder):
    """The same curve on scores that are no probabilities."""
    logits = _predicted(spark, folder).withColumn("z", F.log((F.col("p") + 0.001) / (1.001 - F.col("p"))))
    points = evaluation.roc_points(logits, "z", "label").drop("area")
    return rounded(rounded(points, "tpr", "fpr"), "threshold", digits=6)


@query(S.with_(_ROC, "SELECT round(sum(neg / all_neg * (2 * tp - pos) / (2 * all_pos)), 6) AS auc FROM curve"))
def roc_auc(spark, folder):
    return rounded(evaluation.auc(evaluation.roc_points(_predicted(spark, folder), "p", "label")), "auc", digits=6)


# --- models ------------------------------------------------------------------------------------


def _model_table(spark, folder):
    """Scored prompts as a training set with a split."""
    extract = _minable(spark, folder).withColumns(
        {
            "latency_ms": F.lit(None).cast("double"),
            "attempt_count": F.lit(1),
            "model_name": F.lit(None).cast("string"),
            "task_type": F.lit(None).cast("string"),
        }
    )
    table, features = training.training_set(extract, key="doc_id")
    return stored(training.train_val_test(table, "doc_id"), "training"), features


def _fitted(spark, folder):
    table, features = _model_table(spark, folder)
    train = table.where(F.col("split") == "train")
    return table, features, models.fit_forest(train, features), models.fit_boosted(train, features)


_NUMBERS = {
    "prompt_length": "prompt_length", "token_estimate": "token_estimate", "instruction_density": "instruction_density",
    "complexity_score": "complexity_score", "tokens_used": "coalesce(tokens, 10)", "latency_ms": "100.0", "attempt_count": "1",
    "prompt_word_count": S.words(S.norm("prompt_text")),
    "avg_word_length": f"length(replace(prompt_text, ' ', '')) / CAST({S.words(S.norm('prompt_text'))} + 1 AS DOUBLE)",
    "question_marks": "length(prompt_text) - length(replace(prompt_text, '?', ''))",
    "code_blocks": S.count("prompt_text", "```|<code>"), "list_items": S.count("prompt_text", r"\n-|\n\d+\."),
    "capital_ratio": S.count("prompt_text", "[A-Z]") + " / CAST(length(prompt_text) + 1 AS DOUBLE)",
    "contains_code": "contains_code::INT", "contains_examples": "contains_examples::INT",
    "contains_constraints": "contains_constraints::INT", "success_rate": "success_score",
}
_LABELS = {"language": "language", "prompt_type": "prompt_type"} | {
    name: f"CASE WHEN {name} THEN 'True' ELSE 'False' END" for name in ("contains_code", "contains_examples", "contains_constraints")
}
_TRAINABLE = S.PROMPTS + """,
trainable AS (SELECT * FROM prompts WHERE success_score IS NOT NULL AND coalesce(tokens, 10) > 0),
placed AS (""" + S.split("trainable", "doc_id", _SHARES, "*") + ")"


@query(
    S.with_(
        _TRAINABLE,
        " UNION ALL ".join(
            [f"SELECT doc_id, split, '{name}' AS feature, round(CAST({value} AS DOUBLE), 9) AS value FROM placed" for name, value in _NUMBERS.items()]
            + [
                f"SELECT doc_id, split, '{name}_' || v, CAST(coalesce({value} = v, false)::INT AS DOUBLE) FROM placed, "
                f"(SELECT DISTINCT {value} AS v FROM placed) WHERE v IS NOT NULL"
                for name, value in _LABELS.items()
            ]
        ),
    )
)
def training_set(spark, folder):
    """The feature table the models train on, one row per cell."""
    table, features = _model_table(spark, folder)
    cells = [F.struct(F.lit(name).alias("feature"), F.round(name, S.R).alias("value")) for name in (*features, "success_rate")]
    return table.select("doc_id", "split", F.explode(F.array(*cells)).alias("cell")).select("doc_id", "split", "cell.*")


@query()
def ensemble_metrics(spark, folder):
    """MAE, RMSE and R2 of forest, boosted trees and their mix on the validation and test rows."""
    table, _, forest, boosted = _fitted(spark, folder)
    held_out = table.where(F.col("split") != "train")
    predicted = models.ensemble_predictions(held_out, forest, boosted, ["doc_id", "split", "success_rate"])
    names = {name: name for name in ("forest", "boosted", "ensemble")}
    return evaluation.regression_metrics(predicted, names, "success_rate", by="split")


@query()
def forest_importance(spark, folder):
    table, features = _model_table(spark, folder)
    forest = models.fit_forest(table.where(F.col("split") == "train"), features)
    return models.feature_importance(spark, forest, features)


@query(
    S.with_(
        _TRAINABLE,
        """SELECT split, count(*) AS n, count(*) AS forest_in_range, count(*) AS mixed, true AS errors_agree, true AS below_gate,
        CAST(1 AS DOUBLE) AS importance FROM placed WHERE split <> 'train' GROUP BY 1""",
    )
)
def model_checks(spark, folder):
    """What must hold for the fitted models on held-out rows: a forest stays in the range of its targets, the mix is 60/40,
    the errors are those of the plain formulas and below the test gates, the importances sum to 1.
    """
    table, features, forest, boosted = _fitted(spark, folder)
    held_out = table.where(F.col("split") != "train")
    predicted = stored(models.ensemble_predictions(held_out, forest, boosted, ["doc_id", "split", "success_rate"]), "predicted")
    names = {name: name for name in ("forest", "boosted", "ensemble")}
    metrics = evaluation.regression_metrics(predicted, names, "success_rate", by="split").groupBy("split").pivot("model", list(names)).agg(F.first("mae"))
    mix = 0.6 * F.col("forest") + 0.4 * F.col("boosted")
    plain = predicted.groupBy("split").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("forest").between(0, 1)).alias("forest_in_range"),
        F.count_if(F.abs(F.col("ensemble") - mix) < 1e-9).alias("mixed"),
        *[F.avg(F.abs(F.col(name) - F.col("success_rate"))).alias(f"_{name}") for name in names],
    )
    weight = models.feature_importance(spark, forest, features).agg(F.round(F.sum("importance"), 6).alias("importance"))
    checked = plain.join(metrics, "split").select(
        "split", "n", "forest_in_range", "mixed",
        (F.greatest(*[F.abs(F.col(name) - F.col(f"_{name}")) for name in names]) < 1e-9).alias("errors_agree"),
        ((F.col("forest") < 0.50) & (F.col("boosted") < 0.45)).alias("below_gate"),
    )
    return checked.crossJoin(weight)  # two rows and one


def _clustered(spark, folder):
    table, features = _model_table(spark, folder)
    model = models.fit_clusters(table, features)
    return model.transform(table)


@query()
def cluster_profile(spark, folder):
    return models.cluster_profile(_clustered(spark, folder))


@query(
    S.with_(
        _TRAINABLE,
        """SELECT count(*) AS size, round(avg(prompt_length), 6) AS mean_prompt_length, round(avg(complexity_score), 6) AS mean_complexity,
        round(avg(contains_code::INT), 6) AS has_code_ratio FROM placed""",
    )
)
def cluster_profile_totals(spark, folder):
    """The clusters' profiles, weighted by their sizes, are those of all rows."""
    profile = models.cluster_profile(_clustered(spark, folder))
    whole = {c: F.round(F.sum(F.col(c) * F.col("size")) / F.sum("size"), 6).alias(c) for c in ("mean_prompt_length", "mean_complexity", "has_code_ratio")}
    return profile.agg(F.sum("size").alias("size"), *whole.values())


@query()
def cluster_quality(spark, folder):
    return models.cluster_quality(_clustered(spark, folder))


@query(S.with_(_TRAINABLE, "SELECT 4 AS clusters, count(*) AS rows, count(*) AS nearest, true AS separated, CAST(1 AS DOUBLE) AS share FROM placed"))
def cluster_checks(spark, folder):
    """What must hold for a clustering: sizes add up, every row is in the cluster of its nearest centre, and the silhouette is
    above the test gate.
    """
    table, features = _model_table(spark, folder)
    model = models.fit_clusters(table, features)
    rows = stored(model.transform(table).select("doc_id", "cluster", "projected"), "clusters")
    gaps = [
        F.sqrt(sum((vector_to_array("projected")[i] - float(x)) ** 2 for i, x in enumerate(centre)))
        for centre in model.stages[-1].clusterCenters()
    ]
    nearest = rows.agg(F.count_if(F.get(F.array(*gaps), F.col("cluster")) <= F.least(*gaps) + 1e-9).alias("nearest"))
    sizes = models.cluster_quality(rows).agg(
        F.count("*").cast("int").alias("clusters"), F.sum("size").alias("rows"), (F.max("silhouette") > 0.30).alias("separated"),
        F.round(F.sum("share"), 9).alias("share"),
    )
    return sizes.crossJoin(nearest)  # one row and one


@query()
def complexity_clusters(spark, folder):
    """Three clusters on three scaled columns, with their plane."""
    rows = stored(W.prompts(spark, folder).select("doc_id", "complexity_score", "prompt_length", "token_estimate"), "features")
    columns = ["complexity_score", "prompt_length", "token_estimate"]
    model = models.fit_clusters(rows, columns, k=3, components=2, restarts=25)
    return models.projection(model.transform(rows))


@query(S.with_(S.PROMPTS, "SELECT count(*) AS points, 3 AS clusters, true AS centred, true AS first_axis_wider FROM prompts"))
def projection_checks(spark, folder):
    """What must hold for the plane of `complexity_clusters`: a point per row around the origin, the first axis the wider."""
    plane = stored(complexity_clusters(spark, folder), "plane")
    return plane.agg(
        F.count("*").alias("points"), F.count_distinct("cluster").cast("int").alias("clusters"),
        ((F.abs(F.avg("x")) < 1e-6) & (F.abs(F.avg("y")) < 1e-6)).alias("centred"), (F.stddev("x") >= F.stddev("y")).alias("first_axis_wider"),
    )


def _logistic(spark, folder):
    """Scored prompts with a split, and the success regression fitted on its training part."""
    scored = W.prompts(spark, folder).where(F.col("success_score").isNotNull())
    flags = {name: F.col(name).cast("int") for name in ("contains_code", "contains_examples", "contains_constraints")}
    labelled = scored.withColumns(flags).withColumn("is_successful", (F.col("success_score") >= 0.5).cast("int"))
    split = training.stratified_train_test(labelled, "is_successful", "doc_id")
    split = stored(split, "split")
    return split, models.fit_logistic(split.where(F.col("split") == "train"))


@query()
def logistic_predictions(spark, folder):
    """Class probabilities on the held-out fifth."""
    split, model = _logistic(spark, folder)
    return models.logistic_predictions(split.where(F.col("split") == "test"), model, ["doc_id", "is_successful"])


@query(
    S.with_(
        S.PROMPTS + """,
        outcomes AS (SELECT doc_id, CAST(success_score >= 0.5 AS INTEGER) AS is_successful FROM prompts WHERE success_score IS NOT NULL),
        placed AS (""" + S.split("outcomes", "doc_id", {"train": 0.8, "test": 0.2}, "*", "is_successful") + ")",
        """SELECT count(*) AS n, count(*) AS classed, round(CAST(sum(is_successful) AS DOUBLE), 2) AS expected
        FROM placed WHERE split = 'train'""",
    )
)
def logistic_checks(spark, folder):
    """On its training rows a fitted logistic regression expects as many successes as there are; classes go by 0.5."""
    split, model = _logistic(spark, folder)
    rows = models.logistic_predictions(split.where(F.col("split") == "train"), model, ["doc_id"])
    classed = F.count_if(F.col("predicted") == (F.col("probability") > 0.5).cast("int")).alias("classed")
    return rows.agg(F.count("*").alias("n"), classed, F.round(F.sum("probability"), 2).alias("expected"))


# --- scoring -----------------------------------------------------------------------------------


def _scorable(spark, folder):
    """Documents and benchmark prompts in one list."""
    docs = W.documents(spark, folder).select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.col("text").alias("prompt_text"))
    probes = W.table(spark, folder, "benchmark")
    items = probes.select(F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("id"), F.col("text").alias("prompt_text"))
    return docs.unionByName(items)


_SCORABLE = S.DOCS + """,
scorable AS (SELECT 'd' || doc_id AS id, text AS prompt_text FROM docs UNION ALL SELECT 'b' || item_id, text FROM benchmark)"""


def _heuristic_sql(t: str) -> str:
    """The heuristic score of a text expression."""
    n = S.norm(t)
    solid = f"length(replace({t}, ' ', '')) / CAST(greatest({S.words(n)}, 1) AS DOUBLE)"
    fences = f"((length({t}) - length(replace({t}, '```', ''))) // 3)"
    return (
        f"least(greatest(least(CAST(0.15 AS DOUBLE)"
        f" + CASE WHEN contains(lower({t}), 'example') OR contains(lower({t}), 'e.g.') THEN CAST(0.20 AS DOUBLE) ELSE 0 END"
        f" + CASE WHEN contains(lower({t}), 'must') OR contains(lower({t}), 'only') THEN CAST(0.20 AS DOUBLE) ELSE 0 END"
        f" + CASE WHEN contains({t}, '```') THEN CAST(0.15 AS DOUBLE) ELSE 0 END"
        f" + CASE WHEN length({t}) < 40 THEN CAST(-0.10 AS DOUBLE) WHEN length({t}) > 1200 THEN CAST(-0.05 AS DOUBLE) ELSE CAST(0.05 AS DOUBLE) END"
        f" + CAST(0.10 AS DOUBLE) * 0.5 + CAST(0.10 AS DOUBLE) * least(greatest(({solid} + 2 * {fences}) / 20, 0), 1),"
        f" CAST(0.95 AS DOUBLE)), 0), 1)"
    )


def _scoring_sql(t: str) -> dict[str, str]:
    """The scoring columns of a text expression."""
    n = S.words(S.norm(t))
    solid = f"length(replace({t}, ' ', '')) / CAST(greatest({n}, 1) AS DOUBLE)"
    fences = f"((length({t}) - length(replace({t}, '```', ''))) // 3)"
    flags = {
        "contains_code": f"contains({t}, '```')",
        "contains_examples": f"(contains(lower({t}), 'example') OR contains(lower({t}), 'e.g.'))",
        "contains_constraints": f"(contains(lower({t}), 'must') OR contains(lower({t}), 'only'))",
    }
    columns = {
        "prompt_length": f"length({t})", "instruction_density": "0.5", "complexity_score": f"{solid} + {fences} * 2",
        "tokens_used": f"{n} * CAST(1.3 AS DOUBLE)", "latency_ms": "100", "attempt_count": "1", "prompt_word_count": n,
        "avg_word_length": solid, "question_marks": f"length({t}) - length(replace({t}, '?', ''))", "code_blocks": fences,
        "list_items": S.count(t, chr(92) + "n[-*]"),
        "capital_ratio": S.count(t, chr(92) + "p{Lu}") + f" / CAST(greatest(length({t}), 1) AS DOUBLE)",
        "language_unknown": "1", "prompt_type_roleplay": f"contains(lower({t}), 'act as')::INT",
        "prompt_type_standard": f"(NOT contains(lower({t}), 'act as'))::INT",
    }
    for name, flag in flags.items():
        columns |= {name: f"{flag}::INT", f"{name}_False": f"(NOT {flag})::INT", f"{name}_True": f"{flag}::INT"}
    return {name: f"round(CAST({value} AS DOUBLE), 9)" for name, value in columns.items()}


_SCORING = ", ".join(f"{value} AS {name}" for name, value in _scoring_sql("prompt_text").items())


@query(S.with_(_SCORABLE, f"SELECT id, {_SCORING}, round({_heuristic_sql('prompt_text')}, 9) AS score FROM scorable"))
def heuristic_scores(spark, folder):
    """All scoring columns and the heuristic score."""
    scored = scoring.success_scores(_scorable(spark, folder))
    cells = [F.round(F.col(name).cast("double"), S.R).alias(name) for name in (*scoring.SCORING_COLUMNS, "score")]
    return scored.select("id", *cells)


@query(
    S.with_(
        _SCORABLE + f", featured AS (SELECT id, {_SCORING}, {_heuristic_sql('prompt_text')} AS heuristic FROM scorable)",
        """SELECT id, round(heuristic, 9) AS with_constant_model, round(least(greatest(
        (contains_code / 4 + capital_ratio * 2 + prompt_word_count / 100 - contains_examples) / 2, 0), 1), 9) AS with_models FROM featured""",
    )
)
def scores_with_models(spark, folder):
    """Scores by two models, and by one that can't tell the probe prompts apart, where the heuristic steps in."""

    def model(prediction: str) -> SQLTransformer:
        return SQLTransformer(statement=f"SELECT *, {prediction} AS prediction FROM __THIS__")

    working = [model("contains_code / 4 + capital_ratio * 2"), model("prompt_word_count / 100 - contains_examples")]
    prompts = _scorable(spark, folder)
    by_models = scoring.success_scores(prompts, scoring.usable_models(spark, working))
    by_constant = scoring.success_scores(prompts, scoring.usable_models(spark, [model("double(0.5)")]))
    both = by_models.select("id", F.round("score", S.R).alias("with_models")).join(
        by_constant.select("id", F.round("score", S.R).alias("with_constant_model")), "id"
    )
    return both


def _variants_sql() -> str:
    rows = []
    for place, (name, marker, addition) in enumerate(scoring.VARIANTS, start=1):
        source = "prompt_text" if marker == "```" else "lower(prompt_text)"
        new = f"(prompt_text || {S.lit(addition)})"
        rows.append(
            f"SELECT id, {place} AS place, {S.lit(name)} AS variant, {_heuristic_sql('prompt_text')} AS base, "
            f"{_heuristic_sql(new)} AS score FROM scorable WHERE NOT contains({source}, {S.lit(marker)})"
        )
    return " UNION ALL ".join(rows)


@query(
    S.with_(
        _SCORABLE + f", variants AS ({_variants_sql()})",
        """SELECT id, variant, round(base, 3) AS baseline_score, round(score, 3) AS predicted_score,
        CAST(row_number() OVER (PARTITION BY id ORDER BY round(score, 3) DESC, place) AS INTEGER) AS rank FROM variants WHERE score > base""",
    )
)
def what_if_text(spark, folder):
    return scoring.what_if_text(_scorable(spark, folder), "id")


def _edit_score(code: str, examples: str, constraints: str, complexity: str) -> str:
    return (
        f"least(greatest(least(CAST(0.15 AS DOUBLE) + CAST(0.20 AS DOUBLE) * {examples} + CAST(0.20 AS DOUBLE) * {constraints}"
        f" + CAST(0.15 AS DOUBLE) * {code} + CASE WHEN prompt_length < 40 THEN CAST(-0.10 AS DOUBLE) WHEN prompt_length > 1200"
        f" THEN CAST(-0.05 AS DOUBLE) ELSE CAST(0.05 AS DOUBLE) END + CAST(0.10 AS DOUBLE) * least(instruction_density, 1)"
        f" + CAST(0.10 AS DOUBLE) * least({complexity} / 20, 1), CAST(0.95 AS DOUBLE)), 0), 1)"
    )


_C, _E, _T = "CAST(contains_code AS INT)", "CAST(contains_examples AS INT)", "CAST(contains_constraints AS INT)"


@query(
    S.with_(
        S.PROMPTS + f""",
        edits AS (
          SELECT doc_id, 0 AS place, 'Add explicit code blocks' AS variant, {_edit_score(_C, _E, _T, 'complexity_score')} AS base,
            {_edit_score('1', _E, _T, '(complexity_score + 4)')} AS score FROM prompts WHERE NOT contains_code
          UNION ALL SELECT doc_id, 1, 'Add context or examples', {_edit_score(_C, _E, _T, 'complexity_score')},
            {_edit_score(_C, '1', _T, 'complexity_score')} FROM prompts WHERE NOT contains_examples
          UNION ALL SELECT doc_id, 2, 'Add explicit constraints', {_edit_score(_C, _E, _T, 'complexity_score')},
            {_edit_score(_C, _E, '1', 'complexity_score')} FROM prompts WHERE NOT contains_constraints)""",
        """SELECT doc_id, variant, round(base, 9) AS baseline_score, round(score, 9) AS predicted_score,
        CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, place) AS INTEGER) AS rank FROM edits WHERE score > base""",
    )
)
def what_if_features(spark, folder):
    flags = {name: F.col(name).cast("int") for name in ("contains_code", "contains_examples", "contains_constraints")}
    edits = scoring.what_if_features(W.prompts(spark, folder).withColumns(flags), "doc_id")
    return rounded(edits, "baseline_score", "predicted_score")


def _request_features() -> list[str]:
    return ["prompt_length", "token_estimate", "instruction_density", "complexity_score", "tokens_used", "contains_code",
            "contains_examples", "contains_constraints", "latency_ms", "attempt_count"]


@query()
def model_scores(spark, folder):
    """Prompts scored by a trained forest, with confidence level."""
    requests = W.prompts(spark, folder).select(
        "doc_id", "prompt_length", "token_count", "instruction_density", "complexity_score", "contains_code",
        "contains_examples", "contains_constraints", "success_score",
    )
    requests = stored(requests, "requests")
    known = scoring.with_request_defaults(requests.where(F.col("success_score").isNotNull()))
    forest = models.fit_forest(known, _request_features(), "success_score")
    return scoring.scored_requests(requests, forest).select("doc_id", "success_probability", "confidence_level")


_REQUEST = "coalesce(nullif(CAST({0} AS DOUBLE), 0), {1})".format


@query(
    S.with_(
        S.PROMPTS + f""",
        requests AS (SELECT doc_id, prompt_length, {_REQUEST('token_estimate', 100)} AS token_estimate, {_REQUEST('complexity_score', 0.5)} AS complexity,
          coalesce(contains_code::INT, 0) AS code FROM prompts),
        answered AS (SELECT doc_id, least(greatest(prompt_length / 2000.0 + code / 4.0 - complexity / token_estimate, 0), 1) AS p FROM requests)""",
        """SELECT doc_id, round(p, 9) AS success_probability, CASE WHEN p > 0.7 THEN 'high' WHEN p > 0.4 THEN 'medium' ELSE 'low' END
        AS confidence_level FROM answered""",
    )
)
def request_scores(spark, folder):
    """Prompts as scoring requests to a model that SQL can repeat: defaults, limits and levels."""
    requests = W.prompts(spark, folder).select(
        "doc_id", "prompt_length", "token_count", "instruction_density", "complexity_score", "contains_code", "contains_examples", "contains_constraints"
    )
    model = SQLTransformer(
        statement="SELECT *, prompt_length / 2000.0D + contains_code / 4.0D - complexity_score / token_estimate AS prediction FROM __THIS__"
    )
    return rounded(scoring.scored_requests(requests, model).select("doc_id", "success_probability", "confidence_level"), "success_probability")


_NAMES = " ".join(f"WHEN {k} THEN {S.lit(v)}" for k, v in scoring.CLUSTER_NAMES.items())


@query(
    S.with_(
        S.PROMPTS + ", placed AS (SELECT doc_id, CAST(CASE WHEN token_estimate < 50 THEN 0 WHEN token_estimate < 100 THEN 1 WHEN token_estimate < 400 THEN 2 "
        "WHEN token_estimate < 1000 THEN 3 ELSE 9 END AS INTEGER) AS cluster_id FROM prompts)",
        f"SELECT doc_id, cluster_id, CASE cluster_id {_NAMES} ELSE 'Unknown' END AS cluster_name FROM placed",
    )
)
def named_clusters(spark, folder):
    """Prompts assigned by a model that SQL can repeat, with the clusters' names."""
    prompts = W.prompts(spark, folder).select("doc_id", "token_count")
    model = SQLTransformer(
        statement="SELECT *, CASE WHEN token_count < 50 THEN 0 WHEN token_count < 100 THEN 1 WHEN token_count < 400 THEN 2 "
        "WHEN token_count < 1000 THEN 3 ELSE 9 END AS cluster FROM __THIS__"
    )
    return scoring.clustered(prompts, model).select("doc_id", "cluster_id", "cluster_name")


@query()
def cluster_assignment(spark, folder):
    """Prompts with their cluster and its name."""
    prompts = stored(scoring.scoring_features(_scorable(spark, folder)).select("id", *scoring.SCORING_COLUMNS), "scoring-features")
    model = models.fit_clusters(prompts, scoring.SCORING_COLUMNS)
    return scoring.clustered(prompts, model).select("id", "cluster_id", "cluster_name")


# --- jobs and streams --------------------------------------------------------------------------


def _write_sources(spark, folder) -> str:
    """The raw datasets as they are saved: a train and a test split (rows of the train split once more), with the info
    file beside the rows.
    """
    root = new_folder(spark, "datasets")
    sources = {W.CHAT: W.nested_chats, **W.RAW}
    for name, rows in sources.items():
        for split in ("train", "test"):
            with brief_shuffles(spark):
                rows(spark, folder).write.options(**PACKED).parquet(f"{root}/{name}/{split}")
        info = spark.createDataFrame([(("1.0.0",),)], "version struct<version_str: string>")
        info.coalesce(1).write.json(f"{root}/{name}/train/dataset_info.json")
    return root


@query(
    S.with_(
        S.EVENTS,
        f"""SELECT dataset_name, 'prompt' AS record_type, count(*) AS n FROM events_all WHERE dataset_name <> '{W.CHAT}' GROUP BY 1
        UNION ALL SELECT '{W.CHAT}', 'prompt', count(*) FROM code_pairs
        UNION ALL SELECT '{W.ARENA}', 'comparison', count(*) FROM battles WHERE prompt_text IS NOT NULL""",
    )
)
def transform_counts(spark, folder):
    """Raw dataset folders through the whole transformation; records per source and type."""
    from turnlake.plans.transform import run_transform

    return run_transform(spark, _write_sources(spark, folder), new_folder(spark, "records"), run_ts=W.RUN_TS)


@query(ORACLES["transform_counts"])
def resumed_transform(spark, folder):
    """A run with a row limit, one without that goes on from there, and one that finds everything done."""
    from turnlake.plans.transform import run_transform

    source, out = _write_sources(spark, folder), new_folder(spark, "records")
    run_transform(spark, source, out, limit=20, run_ts=W.RUN_TS)
    run_transform(spark, source, out, resume=True, run_ts=W.RUN_TS)
    return run_transform(spark, source, out, resume=True, run_ts=W.RUN_TS)


@query(
    S.with_(
        S.LIBRARY,
        f"""SELECT conversation_id, turn_number, '{W.LIBRARY}' AS dataset_name, 'fixture' AS collection_method, 'test' AS version,
        '2024-02-01T12:30:00.000' AS ingest_timestamp, '20240201T123000Z' AS batch_id FROM entries""",
    )
)
def lineage(spark, folder):
    """Where the records of the prompt library come from."""
    events = adapters.library_events(W.library(spark, folder), W.RUN_TS, W.LIBRARY)
    lined = with_lineage(events, W.RUN_TS, W.LIBRARY, "fixture", "test")
    columns = ("conversation_id", "turn_number", "dataset_name", "collection_method", "version", "ingest_timestamp", "batch_id")
    return as_text(lined.select(*columns), "ingest_timestamp")


@query(S.with_(_LINE_SQL, "SELECT count(*) FILTER (WHERE prompt_ok) AS passed, true AS aborted FROM judged"))
def strict_validation(spark, folder):
    """The strict form: valid lines pass as a whole, and one invalid line among them ends the job."""
    lines = _json_lines(spark, folder)
    valid = quality.validated(lines).where("valid").select("value")
    try:
        quality.require_valid(lines).write.format("noop").mode("overwrite").save()
        aborted = False
    except SparkRuntimeException as error:
        aborted = "invalid prompt record" in str(error)
    return quality.require_valid(valid).agg(F.count("*").alias("passed")).withColumn("aborted", F.lit(aborted))


@query(
    S.with_(
        S.PROMPTS,
        """SELECT form, count(*) AS rows, CAST(sum(token_estimate) AS BIGINT) AS tokens, count(DISTINCT prompt_hash) AS prompts
        FROM prompts, (VALUES ('csv'), ('json'), ('parquet')) AS f(form) GROUP BY 1""",
    )
)
def result_sinks(spark, folder):
    """The feature table written in three forms and read back."""
    root, table = new_folder(spark, "results"), stored(W.prompts(spark, folder).select("doc_id", "prompt_hash", "token_estimate"), "features")
    parts = []
    for form in ("csv", "json", "parquet"):
        records.write_result(table, f"{root}/{form}", form)
        read = spark.read.schema(table.schema).option("header", "true").format(form).load(f"{root}/{form}")
        sums = read.agg(F.count("*").alias("rows"), F.sum("token_estimate").alias("tokens"), F.count_distinct("prompt_hash").alias("prompts"))
        parts.append(sums.select(F.lit(form).alias("form"), "rows", "tokens", "prompts"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 5")
def first_documents(spark, folder):
    """The first five rows of a table, as its profile shows them."""
    docs = W.table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return raw.first_rows(docs.orderBy("doc_id"))


@query(
    S.with_(
        S.STAGE + "," + S._after_docs(S.COMPARISON_STAGE).replace(S._after_docs(S.BATTLES) + ",", ""),
        """SELECT 'prompt' AS target, count(*) AS processed, count(*) AS loaded FROM stage
        UNION ALL SELECT 'comparison', count(*), count(*) FILTER (WHERE model_a <> '' AND model_b <> '') FROM comparison_stage""",
    )
)
def full_stream_load(spark, folder):
    """Prompts and comparisons as streams, then merged dimensions and rollups: the totals of all micro-batches."""
    source = new_folder(spark, "records")
    files = records.write_parts(_stage(spark, folder), f"{source}/p", 3, "conversation_id")
    records.write_parts(W.comparison_stage(spark, folder), f"{source}/c", 2, "conversation_id")
    house = Warehouse(spark, new_folder(spark, "warehouse"))
    each = -(-files // 2)
    totals = streaming.load_all(
        spark, f"{source}/p", f"{source}/c", house, new_folder(spark, "checkpoint"), files_per_trigger=each, consumed=True
    )
    return totals.select("target", "processed", "loaded")


@query(
    S.with_(
        S.STAGE,
        """SELECT dataset_name, count(*) AS facts, count(DISTINCT prompt_hash) AS prompts, CAST(sum(tokens) AS BIGINT) AS tokens,
        round(sum(success_score), 6) AS score_sum FROM stage GROUP BY 1""",
    )
)
def stream_load(spark, folder):
    """Record files loaded as a stream in several micro-batches; the facts of the resulting warehouse."""
    source = new_folder(spark, "records")
    files = records.write_parts(_stage(spark, folder), source, 6, "conversation_id", "turn_number")
    house = Warehouse(spark, new_folder(spark, "warehouse"))
    stream = streaming.record_stream(spark, source, "prompt", files_per_trigger=-(-files // 3), consumed=True)
    streaming.start_load(stream, "prompt", house, new_folder(spark, "checkpoint")).awaitTermination()
    removed(spark, source)
    facts, sources = house.table("fact_promptexecution"), house.table("dim_source")
    joined = facts.join(sources.select("source_key", "dataset_name"), "source_key")
    counted = joined.groupBy("dataset_name").agg(
        F.count("*").alias("facts"),
        F.count_distinct("prompt_key").alias("prompts"),
        F.sum("tokens").alias("tokens"),
        F.sum("success_score").alias("score_sum"),
    )
    return rounded(counted, "score_sum", digits=6)


@query(
    S.with_(
        S.RUNS,
        f"""SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, coalesce(model_name, 'unknown') AS model_name, count(*) AS attempts,
        round(avg(success_score), {S.R}) AS avg_success FROM runs WHERE success_score IS NOT NULL GROUP BY 1, 2""",
    )
)
def stream_daily_counts(spark, folder):
    """Executions as a stream of eight files, newest days first, counted per day and model; the sum of all batches."""
    source = new_folder(spark, "events")
    events = W.table(spark, folder, "events")
    events.repartitionByRange(8, F.desc("ts")).write.parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    out = new_folder(spark, "daily")
    streaming.start_daily(W.as_executions(stream), out, new_folder(spark, "checkpoint")).awaitTermination()
    return rounded(day_text(streaming.daily_state(spark, out)), "avg_success")
