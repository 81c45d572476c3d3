import math
import random

import numpy as np
import pytest
from conftest import values
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from turnlake.operators import evaluation, models, scoring, training


def test_published_confusion_table(spark):
    counts = spark.createDataFrame([(2711, 2265, 10, 13)], "tp long, fp long, fn long, tn long")
    row = evaluation.confusion_tests(evaluation.confusion_metrics(counts)).first()
    published = {
        "accuracy": 0.5449, "no_information_rate": 0.5443, "kappa": 0.0022, "accuracy_low": 0.531, "accuracy_high": 0.5588,
        "accuracy_p_value": 0.4719, "sensitivity": 0.996325, "specificity": 0.005707, "pos_pred_value": 0.544815,
        "neg_pred_value": 0.565217, "prevalence": 0.544309, "detection_rate": 0.542308, "detection_prevalence": 0.995399,
        "balanced_accuracy": 0.501016,
    }
    for name, value in published.items():
        digits = len(str(value).split(".")[1])
        assert round(row[name], digits) == value, name
    assert row["mcnemar_p_value"] < 2e-16


def test_perfect_and_empty_confusion(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "predicted int, label int")
    row = evaluation.confusion_tests(evaluation.confusion_metrics(evaluation.confusion_counts(df, "predicted", "label"))).first()
    assert (row["accuracy"], row["accuracy_high"], row["specificity"], row["kappa"]) == (1.0, 1.0, None, None)
    assert row["accuracy_low"] == pytest.approx(0.025 ** (1 / 2))


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 0.5, "a"), (0.0, 0.5, "a"), (1.0, 1.0, "b")], "y double, p double, part string")
    by = {r["part"]: r for r in evaluation.regression_metrics(df, {"p": "p"}, "y", by="part").collect()}
    assert (by["a"]["mae"], by["a"]["rmse"], by["a"]["r2"]) == (0.5, 0.5, 0.0) and by["b"]["r2"] is None


def extract(spark, n=400):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        code = rng.random() < 0.5
        score = 1.0 if code and rng.random() < 0.9 else 0.0
        prompt = ("```x``` " if code else "") + "Word? " * rng.randint(1, 30)
        latency = None if i % 10 == 0 else rng.random() * 50
        rows.append((i, prompt if i % 50 else None, len(prompt), None if i % 9 == 0 else 0.1, latency, i % 40, score, "en", "standard", code, False, False))
    ddl = (
        "execution_key long, prompt_text string, prompt_length int, instruction_density double, latency_ms double, tokens_used int, "
        "success_rate double, language string, prompt_type string, contains_code boolean, contains_examples boolean, contains_constraints boolean"
    )
    df = spark.createDataFrame(rows, ddl).withColumns(
        {"model_name": F.lit(None).cast("string"), "task_type": F.lit(None).cast("string"), "complexity_score": F.col("prompt_length") * 0.1, "attempt_count": F.lit(1)}
    )
    return training.with_training_features(df).drop("prompt_text")


def test_training_set(spark):
    table, features = training.training_set(extract(spark).unionByName(extract(spark).limit(5)))
    assert {"contains_code_True", "contains_code_False", "language_en", "prompt_type_standard", "capital_ratio"} <= set(features)
    rows = table.collect()
    assert len(rows) == len({r["execution_key"] for r in rows}) and not any(v is None for r in rows for v in r)
    assert all(r["tokens_used"] > 0 for r in rows) and all(r["execution_key"] % 50 for r in rows)
    assert max(r["latency_ms"] for r in rows) == 100.0  # the default is within the last percent here
    sizes = {r["split"]: r["count"] for r in training.train_val_test(table).groupBy("split").count().collect()}
    assert sizes["train"] == math.ceil(round(0.7 * len(rows), 6))


def test_training_text_features(spark):
    df = spark.createDataFrame([("Ab  C? <code>\n- x\n1. y```",), ("",), (None,)], "prompt_text string")
    row, empty, none = training.with_training_features(df).collect()
    assert (row["prompt_word_count"], row["question_marks"], row["code_blocks"], row["list_items"]) == (7, 1, 2, 2)
    assert row["avg_word_length"] == pytest.approx(20 / 8) and row["capital_ratio"] == pytest.approx(2 / 26)
    assert (empty["prompt_word_count"], empty["avg_word_length"], empty["capital_ratio"]) == (0, 0.0, 0.0)
    assert none["prompt_word_count"] is None


def test_models_learn_and_mix(spark):
    table, features = training.training_set(extract(spark))
    split = training.train_val_test(table).cache()
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    forest = models.fit_forest(train, features, trees=10, depth=4)
    boosted = models.fit_boosted(train, features, rounds=5, depth=3)
    predicted = models.ensemble_predictions(test, forest, boosted, ["execution_key", "success_rate"])
    for row in predicted.collect():
        assert row["ensemble"] == pytest.approx(0.6 * row["forest"] + 0.4 * row["boosted"])
    metrics = evaluation.regression_metrics(predicted, {"forest": "forest", "boosted": "boosted"}, "success_rate")
    assert all(r["mae"] < 0.5 for r in metrics.collect())
    best = models.feature_importance(spark, forest, features).first()["feature"]
    assert best.startswith(("contains_code", "code_blocks", "avg_word", "capital"))
    assert scoring.is_degenerate(spark.createDataFrame([("a",)], "prompt_text string"), [])
    split.unpersist()


def test_clusters(spark):
    rng = random.Random(1)
    rows = [(i, *(rng.gauss(20 * (i % 3), 1) for _ in range(3))) for i in range(150)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    model = models.fit_clusters(df, ["a", "b", "c"], k=3, components=2, restarts=3)
    clustered = model.transform(df)
    assert clustered.groupBy((F.col("id") % 3).alias("g")).agg(F.count_distinct("cluster").alias("n")).where("n > 1").count() == 0
    quality = models.cluster_quality(clustered).collect()
    assert sorted(r["size"] for r in quality) == [50, 50, 50] and quality[0]["silhouette"] > 0.9 and quality[0]["calinski_harabasz"] > 1000
    assert models.projection(clustered).columns == ["x", "y", "cluster"]
    named = scoring.clustered(df, model).select("cluster_id", "cluster_name").distinct().collect()
    assert all(r["cluster_name"] == scoring.CLUSTER_NAMES[r["cluster_id"]] for r in named)


def test_logistic(spark):
    rng = random.Random(3)
    rows = [(i, float(x), int(rng.random() < 1 / (1 + math.exp(-x)))) for i, x in ((i, rng.uniform(-4, 4)) for i in range(500))]
    df = spark.createDataFrame(rows, "id int, x double, is_successful int")
    model = models.fit_logistic(df, features=["x"])
    assert model.stages[-1].coefficients[0] == pytest.approx(1.0, abs=0.35)
    for r in models.logistic_predictions(df, model, ["id"]).collect():
        assert r["predicted"] == int(r["probability"] > 0.5)


def heuristic(text):
    """The score restated in plain Python."""
    lowered, words = text.lower(), text.split()
    average = len(text.replace(" ", "")) / max(len(words), 1)
    complexity = average + 2 * text.count("```")
    score = 0.15 + 0.2 * ("example" in lowered or "e.g." in lowered) + 0.2 * ("must" in lowered or "only" in lowered) + 0.15 * ("```" in text)
    score += -0.1 if len(text) < 40 else -0.05 if len(text) > 1200 else 0.05
    score += 0.1 * 0.5 + 0.1 * min(max(complexity / 20, 0), 1)
    return max(0.0, min(score, 0.95))


def test_scoring_and_what_if(spark):
    texts = ["", "short", "x" * 1300, "You MUST use ```py\n1\n``` e.g. this " + "w " * 20, "an Example?\n- a\n* b É", *scoring.PROBES]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, prompt_text string")
    scored = {r["id"]: r for r in scoring.success_scores(df).collect()}
    assert all(scored[i]["score"] == pytest.approx(heuristic(t)) for i, t in enumerate(texts))
    assert (scored[4]["list_items"], scored[4]["question_marks"], scored[4]["capital_ratio"]) == (2, 1, pytest.approx(2 / 21))
    assert set(scoring.SCORING_COLUMNS) <= set(scored[0].asDict())
    expected = set()
    for i, t in enumerate(texts):
        options = [(n, t + add) for n, mark, add in scoring.VARIANTS if mark not in (t if mark == "```" else t.lower())]
        better = [(round(heuristic(new), 3), n) for n, new in options if heuristic(new) > heuristic(t)]
        ranked = sorted(better, key=lambda o: -o[0])
        expected |= {(i, n, k, s) for k, (s, n) in enumerate(ranked, start=1)}
    got = {(r["id"], r["variant"], r["rank"], r["predicted_score"]) for r in scoring.what_if_text(df, "id").collect()}
    assert got == expected


def test_what_if_by_feature(spark):
    df = spark.createDataFrame([(1, 50, 0, 0, 1, 0.5, 18.0), (2, 50, 1, 1, 1, 0.5, 30.0)],
        "id int, prompt_length int, contains_code int, contains_examples int, contains_constraints int, instruction_density double, complexity_score double")
    got = [(r["id"], r["variant"], r["rank"], round(r["predicted_score"] - r["baseline_score"], 6)) for r in scoring.what_if_features(df, "id").collect()]
    assert got == [(1, "Add context or examples", 1, 0.2), (1, "Add explicit code blocks", 2, 0.16)]


def test_request_defaults_and_labels(spark):
    df = spark.createDataFrame([(None, 0.0, None, None), (7, 0.25, 0.9, True)], "token_count int, instruction_density double, complexity_score double, contains_code boolean")
    df = df.withColumns({"contains_examples": F.lit(None).cast("boolean"), "contains_constraints": F.lit(True)})
    columns = ("token_estimate", "tokens_used", "instruction_density", "complexity_score", "contains_code", "contains_examples", "latency_ms")
    assert values(scoring.with_request_defaults(df), *columns) == [(100.0, 100.0, 0.5, 0.5, 0, 0, 100.0), (7.0, 7.0, 0.25, 0.9, 1, 0, 100.0)]
    levels = spark.createDataFrame([(0.71,), (0.7,), (0.41,), (0.4,)], "p double").select(scoring.confidence_level(F.col("p")).alias("l"))
    assert [r["l"] for r in levels.collect()] == ["high", "medium", "medium", "low"]
    clamped = spark.createDataFrame([(float("nan"),), (float("inf"),), (-1.0,), (2.0,), (None,)], "p double").select(scoring.clamp(F.col("p")).alias("c"))
    assert [r["c"] for r in clamped.collect()] == [0.0, 0.0, 0.0, 1.0, 0.0]


def test_category_values(spark, monkeypatch):
    rows = [("b", True), ("a", False), (None, None), ("a", True)]
    df = spark.createDataFrame(rows, "language string, contains_code boolean")
    assert training.category_values(df) == {"language": ["a", "b"], "contains_code": [False, True]}
    assert training.category_values(df.where("false")) == {"language": [], "contains_code": []}
    monkeypatch.setattr(training, "MOST_VALUES", 3)
    with pytest.raises(ValueError):
        training.category_values(df)


def test_restarts_share_passes_and_equal_plain_kmeans(spark):
    """All restarts move like plain Lloyd rounds from the same centres; the cheapest wins; the fitted stage can be stored."""
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 1.0, (60, 2)) for c in ((0, 0), (6, 1), (2, 7))])
    points = spark.createDataFrame([(row.tolist(),) for row in x], "p array<double>").repartition(4)
    first = models._first_centres(points, 3, 5)
    centres, costs = models.lloyd(points, 3, 5)
    for r in range(5):
        c = first[r].copy()
        for _ in range(20):
            nearest = ((x[:, None] - c) ** 2).sum(axis=2).argmin(axis=1)
            c = np.array([x[nearest == j].mean(axis=0) if (nearest == j).any() else c[j] for j in range(3)])
        assert np.allclose(centres[r], c, atol=1e-3)
        assert costs[r] == pytest.approx(((x[:, None] - c) ** 2).sum(axis=2).min(axis=1).sum(), rel=1e-6)
    calls, whole = [], models._assigned
    df = spark.createDataFrame(x.tolist(), "a double, b double")
    try:
        models._assigned = lambda *args: calls.append(1) or whole(*args)
        model = models.fit_clusters(df, ["a", "b"], k=3, components=None, restarts=20)
    finally:
        models._assigned = whole
    assert len(calls) <= 21
    assert {r["cluster"] for r in model.transform(df).select("cluster").collect()} == {0, 1, 2}


def test_nearest_centre_is_stored_and_read(spark, tmp_path):
    stage = models.NearestCentre([[0.0, 0.0], [5.0, 5.0]], "v", "c")
    stage.save(f"{tmp_path}/stage")
    read = models.NearestCentre.load(f"{tmp_path}/stage")
    df = spark.createDataFrame([(Vectors.dense(1, 1),), (Vectors.dense(4, 9),)], ["v"])
    assert [r["c"] for r in read.transform(df).collect()] == [0, 1] and np.allclose(read.clusterCenters(), [[0, 0], [5, 5]])


def test_equal_points_need_no_more_clusters(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 9 + [(3.0, 4.0)], "a double, b double")
    model = models.fit_clusters(df, ["a", "b"], k=4, components=None, restarts=2)
    assert model.transform(df).select("cluster").distinct().count() == 2
