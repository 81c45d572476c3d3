import datetime as dt

import pytest
from conftest import values

from turnlake.operators import boards, eda


def models(spark):
    rows = [("b", 10, 0.5, 0.5), ("a", 20, 0.5, 1.0), ("c", 5, 0.9, 0.0), ("d", 1, None, None)]
    return spark.createDataFrame(rows, "model_name string, attempts long, avg_success double, median_success double")


def test_model_board(spark):
    board = boards.model_board(models(spark).where("avg_success IS NOT NULL"))
    assert [(r["rank"], r["model_name"], r["success_rate_pct"]) for r in board.orderBy("rank").collect()] == [(1, "c", 90.0), (2, "a", 50.0), (3, "b", 50.0)]
    up = boards.model_board(models(spark), "attempts", "asc", 2)
    assert [r["model_name"] for r in up.orderBy("rank").collect()] == ["d", "c"]
    assert boards.model_board(models(spark)).orderBy("rank").first()["model_name"] == "d"  # missing averages sort first
    for bad in ({"sort_by": "name"}, {"order": "up"}, {"limit": 0}, {"limit": 101}):
        with pytest.raises(ValueError):
            boards.model_board(models(spark), **bad)


def test_language_board(spark):
    rows = [("go", 3, 0.75, 1.0), ("sql", 4, 0.5, 0.5), ("r", 5, 0.49, 0.5)]
    df = spark.createDataFrame(rows, "programming_lang string, prompts long, success_rate double, median_success double")
    assert values(boards.language_board(df), "programming_language", "difficulty_level") == [("go", "easy"), ("r", "hard"), ("sql", "medium")]


def features(spark):
    rows = [(False, False, False, 200, 0.4, 0.5), (True, True, False, 99, 0.8, 1.0), (True, True, True, 9, 1.0, 1.0), (False, False, True, 50, 0.4, 0.0)]
    return spark.createDataFrame(
        rows, "contains_examples boolean, contains_code boolean, contains_constraints boolean, cnt long, avg_success double, median_success double"
    )


def test_feature_board_and_insights(spark):
    board = boards.feature_board(features(spark))
    shown = board.orderBy("position").select("feature_combination_id", "combination", "active_label").collect()
    assert [tuple(r) for r in shown] == [
        ("EX_CO_NT", "examples + code", "2 FEAT"), ("NE_NC_NT", "no features", "BASELINE"), ("NE_NC_CT", "constraints", "1 FEAT"),
    ]
    assert values(boards.feature_insights(board)) == [("examples + code", "constraints", "low")]
    wide = boards.feature_board(features(spark), min_samples=1)
    assert values(boards.feature_insights(wide.where("sample_count >= 100"))) == [("no features", "no features", "medium")]
    assert values(boards.feature_insights(board.limit(0))) == [(None, None, "low")]


def test_templates(spark):
    rows = [("h1", "x" * 200, 5, 0.5, 0.5), ("h2", "", 6, 0.5, 0.5), ("h3", None, 4, 0.9, 1.0)]
    df = spark.createDataFrame(rows, "prompt_hash string, prompt_text string, uses long, avg_success double, median_success double")
    board = boards.template_board(df).orderBy("rank").collect()
    assert [(r["prompt_hash"], len(r["prompt_preview"]), r["full_prompt_available"]) for r in board] == [("h2", 0, False), ("h1", 160, True)]
    assert boards.template_count(df).first()[0] == 2


def timeline(spark):
    days = [dt.date(2024, 1, d) for d in (1, 1, 2, 9)]
    rows = [(d, m, 4, 0.5, None) for d, m in zip(days, ["b", "a", "a", "c"])]
    return spark.createDataFrame(rows, "day date, model_name string, attempts long, avg_success double, median_success double")


def test_timelines(spark):
    rows = timeline(spark)
    assert boards.timeline(rows, as_of=dt.date(2024, 1, 10), days=5).count() == 1
    assert boards.timeline(rows, start=dt.date(2024, 1, 1), end=dt.date(2024, 1, 2), model="a").count() == 2
    with pytest.raises(ValueError):
        boards.timeline(rows, start=dt.date(2024, 1, 1))
    nested = {r["day"].day: [p["model_name"] for p in r["series"]] for r in boards.timeline_nested(rows).collect()}
    assert nested == {1: ["a", "b"], 2: ["a"], 9: ["c"]}
    scope = boards.timeline_scope(rows).first()
    assert (scope["models"], scope["start"].day, scope["end"].day) == (["a", "b", "c"], 1, 9)
    pivot = {r["day"].day: (r["a"], r["b"]) for r in boards.timeline_pivot(rows, ["a", "b"]).collect()}
    assert pivot == {1: (50.0, 50.0), 2: (50.0, None), 9: (None, None)}
    assert boards.latest_days(rows, 1).first()["model_name"] == "c"


def test_efficiency_order(spark):
    rows = [("a", None, 0.5), ("b", 9.0, 0.5), ("c", 1.0, None), ("d", 1.0, 0.9)]
    df = spark.createDataFrame(rows, "model_name string, avg_latency double, avg_success_score double")
    assert [r["model_name"] for r in boards.efficiency_board(df).collect()] == ["d", "b", "a", "c"]
    assert [r["model_name"] for r in boards.efficiency_board(df, 3).orderBy("position").collect()] == ["d", "b", "a"]


def test_kpis_and_adhoc(spark):
    board = boards.model_board(models(spark).where("avg_success IS NOT NULL"))
    languages = boards.language_board(
        spark.createDataFrame([("go", 3, 0.5, 0.5), ("r", 3, 0.5, 0.5)], "programming_lang string, prompts long, success_rate double, median_success double")
    )
    row = boards.dashboard_kpis(board, languages, boards.feature_board(features(spark))).first().asDict()
    assert row == {"total_attempts": 35, "tracked_models": 3, "system_success_pct": 63.3, "top_model": "c", "hardest_language": "go", "feature_combos": 3}
    assert boards.adhoc(spark, {"m": models(spark)}, " select model_name from m where attempts > 5").count() == 2
    assert boards.adhoc(spark, {"big": spark.range(500)}, "SELECT * FROM big").count() == 50
    with pytest.raises(ValueError, match="SELECT"):
        boards.adhoc(spark, {}, "DROP TABLE m")


def test_exploration(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 7.0, 2.0), (4.0, 8.0, 1.0)], "a double, b double, c double")
    cells = {(r["x"], r["y"]): r["r"] for r in eda.correlation_matrix(df, ["a", "b"]).collect()}
    assert len(cells) == 4 and cells["a", "a"] == pytest.approx(1.0) and cells["a", "b"] == cells["b", "a"] == pytest.approx(0.9844, abs=1e-4)
    assert values(eda.missing_values(df)) == [("a", 0), ("b", 0), ("c", 1)]
    row = eda.target_summary(df, "c").first()
    assert (row["total_records"], row["missing"], row["median"], row["max"]) == (4, 1, 1.0, 2.0)
    density = eda.score_density(spark.createDataFrame([(True, 0.1), (True, 0.1), (True, 0.9), (False, 0.4)], "g boolean, s double"), "g", "s", 0.5)
    assert values(density) == [(False, 0, 1, 2.0), (True, 0, 2, pytest.approx(4 / 3)), (True, 1, 1, pytest.approx(2 / 3))]
    langs = spark.createDataFrame([("en", 1.0)] * 51 + [("fr", 0.0)] * 50, "language string, success_score double")
    assert values(eda.language_success(langs)) == [("en", 1.0, 51)]
