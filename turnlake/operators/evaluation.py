"""Evaluation of predictions: regression metrics, confusion statistics and the ROC curve."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlake.operators import scan


def regression_metrics(df: DataFrame, predictions: dict[str, str], target: str, by: str | None = None) -> DataFrame:
    """(model, [by,] n, mae, rmse, r2) of several prediction columns in one pass."""
    keys = [by] if by else []
    y = F.col(target)
    sums: list[Column] = [F.count("*").alias("n"), F.var_pop(target).alias("spread")]
    for model, column in predictions.items():
        gap = y - F.col(column)
        sums += [F.avg(F.abs(gap)).alias(f"{model}_abs"), F.avg(gap * gap).alias(f"{model}_sq")]
    row = df.groupBy(*keys).agg(*sums)
    cells = F.array(
        *[
            F.struct(F.lit(m).alias("model"), F.col(f"{m}_abs").alias("mae"), F.col(f"{m}_sq").alias("mse"))
            for m in predictions
        ]
    )
    flat = row.select(*keys, "n", "spread", F.explode(cells).alias("cell"))
    return flat.select(
        "cell.model",
        *keys,
        "n",
        "cell.mae",
        F.sqrt("cell.mse").alias("rmse"),
        F.when(F.col("spread") > 0, 1 - F.col("cell.mse") / F.col("spread")).alias("r2"),
    )


def confusion_counts(df: DataFrame, predicted: str, actual: str, positive: int = 0) -> DataFrame:
    """One row {tp, fp, fn, tn}; the positive class is 0."""
    says, is_ = F.col(predicted) == positive, F.col(actual) == positive
    return df.agg(
        F.count_if(says & is_).alias("tp"),
        F.count_if(says & ~is_).alias("fp"),
        F.count_if(~says & is_).alias("fn"),
        F.count_if(~says & ~is_).alias("tn"),
    )


def confusion_metrics(counts: DataFrame) -> DataFrame:
    """Closed-form statistics of a row {tp, fp, fn, tn}."""
    tp, fp, fn, tn = (F.col(name) for name in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    accuracy, prevalence, claimed = (F.try_divide(part, n) for part in (tp + tn, tp + fn, tp + fp))
    chance = prevalence * claimed + (1 - prevalence) * (1 - claimed)
    sensitivity, specificity = F.try_divide(tp, tp + fn), F.try_divide(tn, tn + fp)
    return counts.withColumns(
        {
            "n": n,
            "accuracy": accuracy,
            "no_information_rate": F.greatest(prevalence, 1 - prevalence),
            "kappa": F.try_divide(accuracy - chance, 1 - chance),
            "mcnemar_chi2": F.try_divide(F.pow(F.greatest(F.abs(fp - fn) - 1, F.lit(0)), 2), fp + fn),
            "sensitivity": sensitivity,
            "specificity": specificity,
            "pos_pred_value": F.try_divide(tp, tp + fp),
            "neg_pred_value": F.try_divide(tn, tn + fn),
            "prevalence": prevalence,
            "detection_rate": F.try_divide(tp, n),
            "detection_prevalence": claimed,
            "balanced_accuracy": (sensitivity + specificity) / 2,
        }
    )


def _beta_share(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta function: the share of a Beta(a, b) below x, by its continued fraction."""
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_share(b, a, 1.0 - x)

    def terms() -> Iterator[float]:
        m = 0
        while True:
            yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            m += 1
            yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))

    value, above, below = 1.0, 1.0, 0.0
    for term in terms():
        below = 1.0 / (1.0 + term * below)
        above = 1.0 + term / above
        value *= above * below
        if abs(above * below - 1.0) < 1e-15:
            break
    scale = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    return math.exp(scale) / a / value


def _beta_quantile(p: float, a: float, b: float) -> float:
    low, high = 0.0, 1.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _beta_share(a, b, middle) < p else (low, middle)
    return (low + high) / 2


def _tests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for n, accuracy, rate, chi2 in zip(
            frame["n"], frame["accuracy"], frame["no_information_rate"], frame["mcnemar_chi2"]
        ):
            hits = round(accuracy * n)
            rows.append(
                {
                    "accuracy_low": _beta_quantile(0.025, hits, n - hits + 1) if hits else 0.0,
                    "accuracy_high": _beta_quantile(0.975, hits + 1, n - hits) if hits < n else 1.0,
                    "accuracy_p_value": _beta_share(hits, n - hits + 1, rate) if hits else 1.0,
                    "mcnemar_p_value": math.erfc(math.sqrt(chi2 / 2)) if chi2 == chi2 else None,
                }
            )
        yield pd.concat([frame.reset_index(drop=True), pd.DataFrame(rows)], axis=1)


def confusion_tests(metrics: DataFrame) -> DataFrame:
    """Add the exact 95% interval of the accuracy, its one-sided test against the no-information rate and McNemar's
    test. The input has one row per evaluated model.
    """
    extra = "accuracy_low double, accuracy_high double, accuracy_p_value double, mcnemar_p_value double"
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in metrics.dtypes)
    return metrics.mapInPandas(_tests, f"{ddl}, {extra}")


def roc_points(df: DataFrame, probability: str, label: str) -> DataFrame:
    """(threshold, tpr, fpr, area): one point per distinct probability, in falling order.

    Any scores will do, logits as well as probabilities: the distinct ones are laid out in their order over range
    partitions, and running totals come from one scan of each. `area` is the trapezoid to the previous point; the areas
    sum up to the AUC.
    """
    counted = df.groupBy(F.col(probability).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    placed = scan.running(scan.laid(counted, [F.desc("threshold")], "curve"), ["pos", "neg"], totals=True)
    tp, fp = F.col("running_pos"), F.col("running_neg")
    width = F.col("neg") / F.col("total_neg")
    height = (2 * tp - F.col("pos")) / (2 * F.col("total_pos"))
    return placed.select(
        "threshold",
        (tp / F.col("total_pos")).alias("tpr"),
        (fp / F.col("total_neg")).alias("fpr"),
        (width * height).alias("area"),
    )


def auc(points: DataFrame) -> DataFrame:
    return points.agg(F.sum("area").alias("auc"))
