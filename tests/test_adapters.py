import datetime as dt
import hashlib
import json

import pytest
from conftest import values
from pyspark.sql import functions as F

from turnlake import schemas
from turnlake.operators import adapters
from turnlake.plans.transform import transform_rows

RUN = dt.datetime(2024, 5, 1, 8, 0, tzinfo=dt.timezone.utc)
TALK = [
    {"from": "system", "value": "rules"},
    {"from": "user", "value": "ignored, no reply"},
    {"from": " Human ", "value": " one "},
    {"from": "GPT", "value": " first "},
    {"from": "user", "value": "  "},
    {"from": "bot", "value": "reply to nothing"},
    {"from": "user", "value": "two"},
    {"from": "assistant", "value": ""},
    {"from": "user", "value": "trailing"},
]


def test_chat_pairs_and_ids(spark):
    rows = spark.createDataFrame([("c1", TALK), (None, TALK), ("", None), ("c2", [])], schemas.RAW_CHAT)
    events = adapters.chat_events(rows, RUN, "chats")
    payload = json.dumps(TALK, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
    hashed = hashlib.sha256(f"chats:{payload}".encode()).hexdigest()
    pairs = [(1, "one", "first"), (2, "two", None)]
    expected = sorted([(c, *p) for c in ("c1", hashed) for p in pairs])
    assert values(events, "conversation_id", "turn_number", "prompt_text", "response_text") == expected
    assert {row["timestamp"] for row in events.select(F.col("timestamp").cast("string").alias("timestamp")).collect()} == {"2024-05-01 08:00:00"}


def test_missing_conversation_hash(spark):
    rows = spark.createDataFrame([([{"from": "user", "value": None}, {"from": "gpt", "value": "x"}],)], schemas.RAW_CODE_CHAT)
    assert adapters.code_chat_events(rows, RUN, "code").count() == 0


def test_code_chat_labels(spark):
    talk = [{"from": "human", "value": "write code"}, {"from": "gpt", "value": "```rust\nx\n```"}]
    rows = spark.createDataFrame([(talk,)], schemas.RAW_CODE_CHAT)
    assert values(adapters.code_chat_events(rows, RUN, "code"), "task_type", "programming_lang") == [("code_generation", "rust")]


def battle(winner="model_a", a="hi", b="hi", stamp=None, turn=None, question="q"):
    def side(user, *replies):
        return [{"role": "user", "content": user}] + [{"role": "assistant", "content": r} for r in replies]

    return (question, " m1 ", "m2", winner, [(m["content"], m["role"]) for m in side(a, "A", " ", "B")],
            [(m["content"], m["role"]) for m in side(b, "C")], turn, "English", stamp)


@pytest.mark.parametrize(
    ("winner", "labels", "scores"),
    [
        ("model_a", ("winner", "loser"), (1.0, 0.0)),
        (" MODEL_B", ("loser", "winner"), (0.0, 1.0)),
        ("tie", ("tie", "tie"), (0.5, 0.5)),
        ("draw", ("tie", "tie"), (0.5, 0.5)),
        ("tie (bothbad)", ("both_bad", "both_bad"), (0.0, 0.0)),
        ("both bad", ("both_bad", "both_bad"), (0.0, 0.0)),
        ("", ("unknown", "unknown"), (None, None)),
        (None, ("unknown", "unknown"), (None, None)),
    ],
)
def test_battle_outcomes(spark, winner, labels, scores):
    rows = spark.createDataFrame([battle(winner)], schemas.RAW_ARENA)
    got = adapters.arena_events(rows, RUN, "arena").orderBy("model_name").collect()
    assert [r["model_name"] for r in got] == ["m1", "m2"]
    assert tuple(r["quality_label"] for r in got) == labels and tuple(r["success_score"] for r in got) == scores
    assert [r["response_text"] for r in got] == ["A\n\nB", "C"]
    assert {r["turn_number"] for r in got} == {1} and {r["language"] for r in got} == {"English"}


def test_battle_prompts_and_times(spark):
    rows = [
        battle(a=" ", b="from b", stamp="1700000000.5", turn=3, question="x"),
        battle(a=" ", b="", question="y"),
        battle(stamp="2024-01-02T00:00:00Z", question="z"),
        battle(stamp="bad", question="w"),
    ]
    got = adapters.arena_comparisons(spark.createDataFrame(rows, schemas.RAW_ARENA), RUN, "arena")
    shown = got.withColumn("timestamp", F.col("timestamp").cast("string"))
    assert values(shown, "conversation_id", "prompt_text", "timestamp", "model_a") == [
        ("w", "hi", "2024-05-01 08:00:00", "m1"),
        ("x", "from b", "2023-11-14 22:13:20.5", "m1"),
        ("z", "hi", "2024-01-02 00:00:00", "m1"),
    ]


def test_library(spark):
    rows = [("Linux Terminal!", " run it ", "TEXT", True), (None, "b", " ", None), ("x", "  ", None, False)]
    got = adapters.library_events(spark.createDataFrame(rows, schemas.RAW_LIBRARY), RUN, "lib")
    hashed = ["lib:" + hashlib.sha256(t.encode()).hexdigest() for t in ("run it", "b")]
    assert values(got, "conversation_id", "task_type", "prompt_type", "task_category") == sorted(
        [(hashed[0], "linux_terminal", "TEXT", "developer"), (hashed[1], "unknown", None, "general")]
    )


def test_records_and_lineage(spark):
    prompts, comparisons = transform_rows("chatbot_arena", spark.createDataFrame([battle()], schemas.RAW_ARENA), RUN)
    assert prompts.columns == schemas.names(schemas.PROMPT_STAGE)
    assert comparisons.columns == schemas.names(schemas.COMPARISON_STAGE)
    row = prompts.first()
    assert row["batch_id"] == "20240501T080000Z" and row["collection_method"] == "fixture" and row["version"] == "test"
    assert row["session_id"] == hashlib.sha256(b"q").hexdigest() and row["language"] == "en"


def test_unknown_dataset():
    with pytest.raises(ValueError, match="no adapter"):
        adapters.adapter_for("other")
