import json

import pytest
from conftest import values

from turnlake.operators import quality

GOOD = {
    "conversation_id": "c", "turn_number": 1, "prompt_text": "p", "prompt_hash": "a" * 64, "prompt_length": "1",
    "token_estimate": 1.0, "timestamp": "2024-01-02T03:04:05Z", "dataset_name": "d", "tokens": 3,
}
BAD = [
    {"conversation_id": " "}, {"conversation_id": 5}, {"prompt_text": None}, {"prompt_text": "　"},
    {"prompt_hash": "a" * 63}, {"dataset_name": ""}, {"timestamp": "soon"}, {"timestamp": 1700000000},
    {"turn_number": None}, {"turn_number": "1.5"}, {"prompt_length": []}, {"tokens": "many"},
    {"response_tokens": "x"}, {"success_score": "high"},
]
FINE = [{}, {"response_tokens": None}, {"response_tokens": 4}, {"success_score": "0.5"}, {"turn_number": True}, {"extra": 1}]


def lines(spark, records):
    rows = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    return spark.createDataFrame(rows, "value string")


def test_prompt_rules(spark):
    missing = [{k: v for k, v in GOOD.items() if k != name} for name in GOOD]
    bad = [GOOD | change for change in BAD] + missing
    fine = [GOOD | change for change in FINE]
    judged = quality.validated(lines(spark, bad + fine)).select("value", "valid").collect()
    verdict = {row["value"]: row["valid"] for row in judged}
    assert [r for r in bad if verdict[json.dumps(r)]] == []
    assert [r for r in fine if not verdict[json.dumps(r)]] == []


def test_comparison_rules(spark):
    good = {"conversation_id": None, "prompt_text": "p", "prompt_hash": None, "timestamp": "2024-01-02", "dataset_name": "d",
            "model_a": "a", "model_b": "b", "winner": None}
    bad = [{k: v for k, v in good.items() if k != "winner"}, good | {"model_a": " "}, good | {"timestamp": "x"}]
    judged = {r["value"]: r["valid"] for r in quality.validated(lines(spark, [good, *bad]), "comparison").collect()}
    assert judged[json.dumps(good)] and not any(judged[json.dumps(b)] for b in bad)


def test_report_counts_broken_json_but_not_blank_lines(spark):
    report = quality.validity_report(lines(spark, [GOOD, "{broken", "", "   ", "[1, 2]", GOOD | {"tokens": "x"}]))
    assert values(report) == [(4, 1, 3)]


def test_strict_form_fails(spark):
    assert quality.require_valid(lines(spark, [GOOD])).count() == 1
    with pytest.raises(Exception, match="invalid prompt record"):
        quality.require_valid(lines(spark, [GOOD, GOOD | {"tokens": None}])).collect()


def test_contract(spark):
    ddl = "prompt_text string, task_type string, model string, timestamp string, tokens string, success_score string, latency string"
    rows = [
        (" a ", "t", " m", "2024-01-02T03:04:05", "5", "0.5", "x"),
        ("b", "t", "m", "2024/01/02 03:04:05", " 7 ", "1", "2.5"),
        ("c", "t", "m", "02 Jan", "5", "1", None),
        ("d", "t", "m", "2024-01-02 03:04:05", "5.5", "1", None),
        ("e", "t", "m", "2024-01-02 03:04:05", "5", None, None),
    ]
    df = spark.createDataFrame(rows, ddl)
    assert values(quality.clean_contract(df), "prompt_text", "model", "tokens", "latency") == [("a", "m", 5, None), ("b", "m", 7, 2.5)]
    with pytest.raises(ValueError, match="latency|model"):
        quality.clean_contract(df.drop("model"))


def test_stage_hygiene(spark):
    ddl = "conversation_id string, prompt_text string, prompt_hash string, timestamp string, dataset_name string"
    rows = [
        (" c\x00 ", " a\r\nb\rc\x00 ", "  ABC ", "1700000000", "d"),
        ("c", "ab", "", "bad", "d"),
        ("c", "", None, "", "d"),
        ("c", None, " ", None, "d"),
    ]
    stage = quality.staged(spark.createDataFrame(rows, ddl))
    got = values(stage, "conversation_id", "prompt_text", "prompt_hash", "rejected")
    assert ("c", " a\nb\nc ", "abc", False) in got
    assert ("c", "ab", "fb8e20fc2e4c3f248c60c39bd652f3c1347298bb977b8b4d5903b85055620603", False) in got
    assert sum(r[3] for r in got) == 2
    assert [r["t"] for r in stage.selectExpr("cast(timestamp AS string) AS t").collect()] == ["2023-11-14 22:13:20", None, None, None]
    counts = quality.load_counts(stage, quality.accepted(stage).limit(1), ["dataset_name"])
    assert values(counts, "processed", "staged", "loaded", "rejected") == [(4, 2, 1, 3)]
