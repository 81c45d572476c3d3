"""Fits deal the rows of a table of few files over all cores."""

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from turnlake.operators import models


@pytest.mark.parametrize("fit", ["fit_forest", "fit_boosted"])
def test_fit_reads_every_row_on_all_cores(spark, monkeypatch, fit):
    seen = []
    monkeypatch.setattr(Pipeline, "fit", lambda self, rows: seen.append(rows))
    train = spark.range(1000).select((F.col("id") % 7).alias("a"), (F.col("id") / 10).alias("b"), F.lit(0.5).alias("success_rate"), "id")
    getattr(models, fit)(train.coalesce(1), ["a", "b"])
    parts = [len(part) for part in seen[0].rdd.glom().collect()]
    assert len(parts) >= spark.sparkContext.defaultParallelism and min(parts) > 100
    read = ["a", "b", "success_rate"]
    assert seen[0].columns == read and not seen[0].exceptAll(train.select(*read)).count() and sum(parts) == 1000
