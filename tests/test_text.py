import hashlib

import pytest
from pyspark.sql import functions as F

from turnlake.functions import tasks, text, times
from turnlake.operators.features import with_prompt_features


def one(spark, column, **values):
    ddl = ", ".join(f"{name} string" for name in values)
    return spark.createDataFrame([tuple(values.values())], ddl).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [("a 　b", "a b"), ("\ta\n\nb \x1f", "a b"), (" ", ""), (None, ""), ("a  b\r\nc", "a b c")],
)
def test_normalize_uses_unicode_whitespace(spark, raw, expected):
    assert one(spark, text.normalize(F.col("t")), t=raw) == expected


def test_blanks_are_the_characters_python_strips():
    assert set(text.BLANKS) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


@pytest.mark.parametrize(("raw", "tokens", "words"), [("", 0, 0), ("a", 1, 1), ("abcd", 1, 1), ("ab de", 2, 2)])
def test_token_and_word_counts(spark, raw, tokens, words):
    norm = text.normalize(F.col("t"))
    assert one(spark, text.token_estimate(norm), t=raw) == tokens
    assert one(spark, text.word_count(norm), t=raw) == words


@pytest.mark.parametrize(
    ("prompt", "reply", "expected"),
    [
        ("```xyz\n```", "```js\n```", "javascript"),
        ("```xyz\n``` uses python", None, "python"),
        ("some javascript here", None, "javascript"),
        ("some java here", None, "java"),
        ("powershell", None, "bash"),  # "shell" stands before "powershell" in the list
        ("let us go", None, "go"),
        ("gopher", None, None),
        ("", "C++", "cpp"),
        ("Plain words", None, None),
    ],
)
def test_programming_language(spark, prompt, reply, expected):
    assert one(spark, text.programming_language("p", "r"), p=prompt, r=reply) == expected


@pytest.mark.parametrize(
    ("raw", "generic", "code"),
    [
        ("prefix it", "debugging", "unknown"),
        ("fixing it", "unknown", "unknown"),
        ("the debugger", "debugging", "unknown"),
        ("please write code", "code_generation", "code_generation"),
        ("sql or debug", "debugging", "database"),
        ("explain SQL", "explanation", "database"),
        (None, "unknown", "unknown"),
    ],
)
def test_task_rules(spark, raw, generic, code):
    assert one(spark, tasks.task_type(F.lit(None).cast("string"), F.col("t")), t=raw) == generic
    assert one(spark, tasks.code_task(F.col("t")), t=raw) == code


def test_task_label_wins_unless_unknown(spark):
    assert one(spark, tasks.task_type(F.lit(" Data-Viz! "), F.col("t")), t="debug") == "data_viz"
    assert one(spark, tasks.task_type(F.lit("Unknown"), F.col("t")), t="debug") == "debugging"
    assert one(spark, tasks.slug(F.col("t")), t="__!") == "unknown"


@pytest.mark.parametrize(
    ("raw", "label", "expected"),
    [
        ("x", "Mandarin", "zh"),
        ("x", " Klingon ", "klingon"),
        ("x", "　", "unknown"),
        ("", None, "unknown"),
        ("der Hund und die Katze", None, "de"),
        ("the cat and the dog", "", "en"),
        ("こんにちは", None, "ja"),
        ("zzz qqq", None, "unknown"),
    ],
)
def test_spoken_language(spark, raw, label, expected):
    assert one(spark, text.spoken_language("t", "l"), t=raw, l=label) == expected


def test_feature_bundle(spark):
    prompt = "  Act as a poet.\nYou must write only this, e.g. one example:\n```python\nx = 1\n```  "
    rows = [(prompt, "ok ", None, "Story Mode"), ("", None, "English", None), ("fix " + "w " * 31, "", None, "How To")]
    df = spark.createDataFrame(rows, "prompt_text string, response_text string, language string, prompt_type string")
    first, empty, dense = with_prompt_features(df).collect()
    stripped = prompt.strip()
    normalized = " ".join(stripped.split())
    assert first["prompt_text"] == stripped and first["response_text"] == "ok"
    assert first["prompt_hash"] == hashlib.sha256(normalized.encode()).hexdigest()
    assert first["prompt_length"] == first["length"] == len(stripped)
    tokens = -(-len(normalized) // 4)
    assert first["token_estimate"] == first["token_count"] == tokens
    assert first["response_tokens"] == 1 and first["tokens"] == tokens + 1
    assert first["prompt_type"] == first["type"] == "roleplay"
    assert (first["contains_code"], first["contains_examples"], first["contains_constraints"]) == (True, True, True)
    assert (first["example_count"], first["constraint_count"]) == (2, 2)
    assert first["complexity_score"] == round(0.4 * tokens + 0.3 * 2 + 0.3 * 2, 4)
    assert first["instruction_density"] == round(1 / len(normalized.split()), 4)
    assert first["programming_lang"] == "python"
    assert empty["tokens"] == 0 and empty["response_tokens"] is None and empty["language"] == "en"
    assert empty["prompt_type"] == "standard" and empty["instruction_density"] == 0.0
    assert dense["response_tokens"] is None and dense["prompt_type"] == "how_to"
    assert dense["instruction_density"] == 0.0313  # 1/32: half-up, unlike half-even


def test_code_needs_a_closed_fence(spark):
    assert one(spark, text.has_code(F.col("t")), t="```py\nx\n```") is True
    assert one(spark, text.has_code(F.col("t")), t="```py\nx") is False
    assert one(spark, text.has_code(F.col("t")), t="```py x```") is False
    assert one(spark, text.has_code(F.col("t")), t=None) is False


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("2024-01-02T03:04:05Z", "2024-01-02 03:04:05"),
        ("2024-01-02T03:04:05+02:00", "2024-01-02 01:04:05"),
        ("2024-01-02 03:04:05.5", "2024-01-02 03:04:05.5"),
        ("2024-01-02", "2024-01-02 00:00:00"),
        ("1700000000", "2023-11-14 22:13:20"),
        ("1700000000.25", "2023-11-14 22:13:20.25"),
        ("2024", "1970-01-01 00:33:44"),
        ("2024-13-02", None),
        ("soon", None),
        (" ", None),
        (None, None),
    ],
)
def test_utc_timestamp(spark, raw, expected):
    assert one(spark, times.utc_timestamp(F.col("t")).cast("string"), t=raw) == expected


def test_calendar(spark):
    day = F.lit("2023-01-01").cast("timestamp")
    row = spark.range(1).select(*[c.alias(n) for n, c in times.calendar(day).items()], times.monday_week(day).alias("w")).first()
    assert (row["week_number"], row["w"], row["day_of_week"], row["is_weekend"], row["quarter"]) == (52, 0, 7, True, 1)
    later = F.lit("2024-01-08").cast("timestamp")
    assert spark.range(1).select(times.monday_week(later).alias("w")).first()["w"] == 2
