import math
import random
import statistics

import numpy as np
import pytest
from conftest import values
from pyspark.sql import functions as F

from turnlake.operators import evaluation, ordered, star


def hot_scores(seed=1):
    """One key holds a third of the rows; its scores are continuous."""
    rng = random.Random(seed)
    return [("hot" if i % 3 == 0 else f"k{i % 7}", rng.random() if i % 3 == 0 else rng.choice([0.0, 0.5, 1.0])) for i in range(900)]


def test_score_summary(spark):
    rows = hot_scores() + [("hot", None), (None, 0.25)]
    df = spark.createDataFrame(rows, "k string, success_score double")
    got = {r["k"]: r for r in ordered.score_summary(ordered.score_counts(df, ["k"]), ["k"]).collect()}
    for key in {k for k, _ in rows}:
        scores = [s for k, s in rows if k == key and s is not None]
        assert got[key]["n"] == len(scores)
        assert math.isclose(got[key]["mean"], statistics.fmean(scores))
        assert math.isclose(got[key]["median"], statistics.median(scores))


@pytest.mark.parametrize("bins", [2, 16, 1024])
def test_exact_quantiles(spark, bins):
    rng = random.Random(4)
    a = [rng.choice([1.0, 1.0, 1.0, rng.random() * 1000]) for _ in range(700)]
    b = [None if i % 5 == 0 else float(i % 11) for i in range(700)]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double").repartition(6)
    probs = [0.0, 0.1, 0.5, 0.75, 0.99, 1.0]
    got = ordered.exact_quantiles(df, {"a": probs, "b": probs}, bins)
    assert np.allclose(got["a"], np.quantile(a, probs), rtol=0, atol=1e-9)
    assert np.allclose(got["b"], np.quantile([v for v in b if v is not None], probs), rtol=0, atol=1e-9)


def test_exact_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "a double")
    assert ordered.exact_quantiles(df, {"a": [0.5, 0.9]}) == {"a": [None, None]}


@pytest.mark.parametrize("n", [1, 7, 100, 1003])
def test_split_sizes_are_exact_and_stable(spark, n):
    df = spark.range(n).withColumnRenamed("id", "key")
    shares = {"train": 0.7, "val": 0.15, "test": 0.15}
    split = ordered.with_split(df, "key", shares)
    sizes = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    cuts = [math.ceil(round(n * 0.7, 6)), math.ceil(round(n * 0.85, 6)), n]
    assert [sizes.get(name, 0) for name in shares] == [cuts[0], cuts[1] - cuts[0], cuts[2] - cuts[1]]
    assert values(split) == values(ordered.with_split(df.repartition(7), "key", shares))


def test_stratified_split(spark):
    df = spark.range(500).select(F.col("id").alias("key"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    split = ordered.with_split(df, "key", {"train": 0.8, "test": 0.2}, strata="label")
    assert values(split.groupBy("label", "split").count()) == [(0, "test", 90), (0, "train", 360), (1, "test", 10), (1, "train", 40)]


def test_samples(spark):
    at = F.timestamp_seconds(F.col("id") * 7 % 300)
    df = spark.range(300).select(F.col("id").alias("key"), at.alias("at"))
    assert star.random_rows(df, "key", 50).count() == 50
    assert values(star.random_rows(df, "key", 50)) == values(star.random_rows(df.repartition(9), "key", 50))
    assert star.random_rows(df, "key", 1000).count() == 300
    assert sorted(r["at"].second for r in star.newest(df, "at", "key", 5).collect()) == [55, 56, 57, 58, 59]
    tied = spark.range(300).select(F.col("id").alias("key"), F.timestamp_seconds(F.least(F.col("id"), F.lit(9))).alias("at"))
    assert sorted(r["key"] for r in star.newest(tied, "at", "key", 3).collect()) == [297, 298, 299]


def test_roc_equals_brute_force(spark):
    rng = random.Random(2)
    rows = [(rng.choice([0.1, 0.1001, 0.5, rng.random()]), rng.randint(0, 1)) for _ in range(400)]
    points = evaluation.roc_points(spark.createDataFrame(rows, "p double, y int"), "p", "y")
    pos, neg = sum(y for _, y in rows), sum(1 - y for _, y in rows)
    for row in points.collect():
        assert math.isclose(row["tpr"], sum(y for p, y in rows if p >= row["threshold"]) / pos)
        assert math.isclose(row["fpr"], sum(1 - y for p, y in rows if p >= row["threshold"]) / neg)
    wins = sum((a > b) + 0.5 * (a == b) for a, y in rows if y for b, z in rows if not z)
    assert math.isclose(evaluation.auc(points).first()["auc"], wins / (pos * neg))


@pytest.mark.parametrize("n", [0, 2, 4, 9])
def test_first_rows_puts_missing_orders_last(spark, n):
    df = spark.createDataFrame([(1, 3.0), (2, None), (3, 1.0), (4, float("nan")), (5, 1.0)], "id int, v double")
    got = [r["id"] for r in ordered.first_rows(df, F.col("v"), [F.asc("id")], n).collect()]
    assert got == [3, 5, 1, 2, 4][:n]
    assert ordered.first_rows(df.where("false"), F.col("v"), [F.asc("id")], 3).count() == 0


def test_first_rows_of_whole_numbers_and_heavy_ties(spark):
    rng = random.Random(12)
    rows = [(i, rng.choice([None, 5, 5, 5, -(2**40), 2**62, rng.randrange(-(2**62), 2**62)])) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, v long").repartition(5)
    expected = [i for i, v in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[0]))]
    for n, low_bits in ((1, 32), (60, 0), (250, 32), (499, 61), (500, 32), (700, 32)):
        assert [r["id"] for r in ordered.first_rows(df, F.col("v"), [F.asc("id")], n, low_bits).collect()] == expected[:n]


def test_roc_of_scores_beyond_one(spark):
    rng = random.Random(5)
    rows = [(rng.choice([-1e6, 3.5, rng.gauss(0, 1000)]), rng.randint(0, 1)) for _ in range(300)]
    points = evaluation.roc_points(spark.createDataFrame(rows, "z double, y int").repartition(6), "z", "y")
    wins = sum((a > b) + 0.5 * (a == b) for a, y in rows if y for b, z in rows if not z)
    pos = sum(y for _, y in rows)
    assert math.isclose(evaluation.auc(points).first()["auc"], wins / (pos * (300 - pos)))
    assert points.count() == len({z for z, _ in rows})
