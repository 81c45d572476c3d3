"""Spark ML models: forest, boosted trees, their ensemble, clustering and logistic regression."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEED = 42


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def _over_cores(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns that a fit reads, dealt over all cores: tables of features are so narrow that few files hold them, and each
    of a fit's many passes would run on as many cores as there are files.
    """
    narrow = train.select(*dict.fromkeys(columns))
    return narrow.repartition(max(train.sparkSession.sparkContext.defaultParallelism, train.rdd.getNumPartitions()))


def fit_forest(
    train: DataFrame, features: Sequence[str], target: str = "success_rate", trees: int = 100, depth: int = 15
) -> PipelineModel:
    """Regression forest; at least 5 rows per leaf stands in for 10 rows per split."""
    forest = RandomForestRegressor(
        labelCol=target, numTrees=trees, maxDepth=depth, minInstancesPerNode=5, featureSubsetStrategy="all", seed=SEED
    )
    return Pipeline(stages=[_assembler(features), forest]).fit(_over_cores(train, [*features, target]))


def fit_boosted(
    train: DataFrame, features: Sequence[str], target: str = "success_rate", rounds: int = 100, depth: int = 8
) -> PipelineModel:
    boosted = GBTRegressor(
        labelCol=target, maxIter=rounds, maxDepth=depth, stepSize=0.1, seed=SEED, checkpointInterval=10
    )
    return Pipeline(stages=[_assembler(features), boosted]).fit(_over_cores(train, [*features, target]))


def ensemble_predictions(
    rows: DataFrame, forest: PipelineModel, boosted: PipelineModel, keep: Sequence[str], weight: float = 0.6
) -> DataFrame:
    """Both predictions and their 60/40 mix. The models run one after the other on the same rows, so no join."""
    first = forest.transform(rows).drop("features").withColumnRenamed("prediction", "forest")
    both = boosted.transform(first).withColumnRenamed("prediction", "boosted")
    mixed = weight * F.col("forest") + (1 - weight) * F.col("boosted")
    return both.select(*keep, "forest", "boosted", mixed.alias("ensemble"))


def feature_importance(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(feature, importance), best first: one row per feature."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(weight)) for name, weight in zip(features, weights)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


class NearestCentre(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the number of the nearest centre to rows with a vector column."""

    centres = Param(Params._dummy(), "centres", "list of centres", TypeConverters.identity)
    space = Param(Params._dummy(), "space", "vector column", TypeConverters.toString)
    prediction = Param(Params._dummy(), "prediction", "column of the cluster's number", TypeConverters.toString)

    def __init__(self, centres: Sequence[Sequence[float]] = (), space: str = "projected", prediction: str = "cluster") -> None:
        super().__init__()
        self._set(centres=[[float(x) for x in c] for c in centres], space=space, prediction=prediction)

    def clusterCenters(self) -> list[np.ndarray]:
        return [np.array(c) for c in self.getOrDefault(self.centres)]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        place = "vector_to_array_"
        gaps = [
            f"aggregate(zip_with({place}, array({', '.join(f'{x!r}D' for x in c)}), (a, b) -> (a - b) * (a - b)), 0D, (sum, x) -> sum + x)"
            for c in self.getOrDefault(self.centres)
        ]
        nearest = F.expr(f"get(transform(array(array({', '.join(gaps)})), d -> cast(array_position(d, array_min(d)) - 1 AS int)), 0)")
        placed = dataset.withColumn(place, vector_to_array(self.getOrDefault(self.space)))
        return placed.withColumn(self.getOrDefault(self.prediction), nearest).drop(place)


def _first_centres(points: DataFrame, k: int, restarts: int, sample: int = 2_000) -> np.ndarray:
    """Centres of every restart, spread by distance (k-means++) over at most `sample` distinct points in a hash order."""
    rows = points.select("p").orderBy(F.xxhash64("p"), "p").limit(sample).collect()
    found = np.unique(np.array([r["p"] for r in rows], float), axis=0)
    out = []
    for restart in range(restarts):
        rng = np.random.default_rng([SEED, restart])
        chosen = [found[rng.integers(len(found))]]
        while len(chosen) < k:
            gap = np.min([((found - c) ** 2).sum(axis=1) for c in chosen], axis=0)
            chosen.append(found[rng.choice(len(found), p=gap / gap.sum())] if gap.sum() > 0 else chosen[-1])
        out.append(chosen)
    return np.array(out)


def _assigned(points: DataFrame, centres: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """One pass for all restarts: per restart the clusters' sums and sizes, and the cost. Tasks send restarts x clusters rows."""
    restarts, k, axes = centres.shape
    flat = centres.reshape(restarts * k, axes)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, sizes, costs = np.zeros((restarts, k, axes)), np.zeros((restarts, k)), np.zeros((restarts, k))
        for batch in stream:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, axes)
            gaps = ((x**2).sum(axis=1)[:, None] - 2 * x @ flat.T + (flat**2).sum(axis=1)).reshape(-1, restarts, k)
            nearest = gaps.argmin(axis=2)
            for r in range(restarts):
                sizes[r] += np.bincount(nearest[:, r], minlength=k)
                costs[r] += np.bincount(nearest[:, r], np.maximum(gaps[np.arange(len(x)), r, nearest[:, r]], 0), k)
                for axis in range(axes):
                    sums[r, :, axis] += np.bincount(nearest[:, r], x[:, axis], k)
        ids = np.arange(restarts * k)
        rows = {"restart": ids // k, "cluster": ids % k, "size": sizes.ravel(), "cost": costs.ravel()}
        lists = pa.array(list(sums.reshape(restarts * k, axes)), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([*(pa.array(v) for v in rows.values()), lists], names=[*rows, "sums"])

    parts = points.select("p").mapInArrow(run, "restart bigint, cluster bigint, size double, cost double, sums array<double>")
    added = parts.select("restart", "cluster", "size", "cost", *(F.col("sums")[i].alias(f"s{i}") for i in range(axes)))
    rows = added.groupBy("restart", "cluster").agg(*(F.sum(c).alias(c) for c in ("size", "cost", *(f"s{i}" for i in range(axes))))).collect()
    out = {r: (np.zeros((k, axes)), np.zeros(k), 0.0) for r in range(restarts)}
    for row in rows:
        sums, sizes, cost = out[row["restart"]]
        sums[row["cluster"]], sizes[row["cluster"]] = [row[f"s{i}"] for i in range(axes)], row["size"]
        out[row["restart"]] = (sums, sizes, cost + row["cost"])
    return out


def lloyd(points: DataFrame, k: int, restarts: int, rounds: int = 20, near: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """(centres, cost) of every restart of K-Means on the column `p` (array<double>).

    All restarts that still move share each pass over the points, so there are as many passes as rounds.
    """
    centres = _first_centres(points, k, restarts)
    moving = np.arange(restarts)
    for _ in range(rounds):
        found = _assigned(points, centres[moving])
        moved = centres.copy()
        for place, restart in enumerate(moving):
            sums, sizes, _ = found[place]
            held = sizes > 0  # an empty cluster keeps its centre
            moved[restart][held] = sums[held] / sizes[held][:, None]
        gaps = np.sqrt(((moved - centres) ** 2).sum(axis=2)).max(axis=1)
        centres, moving = moved, moving[gaps[moving] > near]
        if not len(moving):
            break
    final = _assigned(points, centres)
    return centres, np.array([final[r][2] for r in range(restarts)])


def fit_clusters(
    df: DataFrame, features: Sequence[str], k: int = 4, components: int | None = 10, restarts: int = 20
) -> PipelineModel:
    """Scale, project, K-Means; the restart with the lowest cost wins.

    The projected rows feed every round, so they are cached once (and can be recomputed if an executor is lost).
    """
    prepared = [_assembler(features), StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)]
    space = "scaled"
    if components:
        prepared.append(PCA(k=min(components, len(features)), inputCol="scaled", outputCol="projected"))
        space = "projected"
    preparation = Pipeline(stages=prepared).fit(df)
    points = preparation.transform(df).select(vector_to_array(space).alias("p")).persist()
    centres, costs = lloyd(points, k, restarts)
    points.unpersist()
    return PipelineModel(stages=[*preparation.stages, NearestCentre(centres[costs.argmin()], space)])


def projection(clustered: DataFrame, space: str = "projected") -> DataFrame:
    """First two coordinates and the cluster of every row: the table behind a cluster plot."""
    place = vector_to_array(space)
    return clustered.select(place[0].alias("x"), place[1].alias("y"), "cluster")


def cluster_quality(clustered: DataFrame, space: str = "projected") -> DataFrame:
    """One row per cluster: size, share, and the silhouette and Calinski-Harabasz index of the whole clustering."""
    spark = clustered.sparkSession
    silhouette = ClusteringEvaluator(featuresCol=space, predictionCol="cluster").evaluate(clustered)
    coordinates = clustered.select("cluster", F.posexplode(vector_to_array(space)).alias("axis", "v"))
    # Per cluster and axis: size, mean, within-cluster sum of squares. Bounded by clusters x axes rows.
    parts = coordinates.groupBy("cluster", "axis").agg(
        F.count("*").alias("n"), F.avg("v").alias("mean"), (F.var_pop("v") * F.count("*")).alias("within")
    )
    centre = parts.groupBy("axis").agg((F.sum(F.col("mean") * F.col("n")) / F.sum("n")).alias("centre"))
    spread = parts.join(centre, "axis").agg(
        F.sum(F.col("n") * F.pow(F.col("mean") - F.col("centre"), 2)).alias("between"), F.sum("within").alias("within")
    )
    sizes = clustered.groupBy("cluster").agg(F.count("*").alias("size"))
    totals = sizes.agg(F.sum("size").alias("rows"), F.count("*").alias("k")).first()
    dispersion = spread.first()
    index = None
    if totals["k"] > 1 and dispersion["within"]:
        index = (dispersion["between"] / (totals["k"] - 1)) / (dispersion["within"] / (totals["rows"] - totals["k"]))
    return sizes.select(
        "cluster",
        "size",
        (F.col("size") / totals["rows"]).alias("share"),
        F.lit(silhouette).alias("silhouette"),
        F.lit(index).cast("double").alias("calinski_harabasz"),
    )


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Size, mean length, mean complexity and code share per cluster, in the units of the data."""
    return clustered.groupBy("cluster").agg(
        F.count("*").alias("size"),
        F.avg("prompt_length").alias("mean_prompt_length"),
        F.avg("complexity_score").alias("mean_complexity"),
        F.avg(F.col("contains_code").cast("double")).alias("has_code_ratio"),
    )


GLM_FEATURES = (
    "prompt_length", "complexity_score", "instruction_density", "contains_code", "contains_examples",
    "contains_constraints",
)


def fit_logistic(train: DataFrame, target: str = "is_successful", features: Sequence[str] = GLM_FEATURES) -> PipelineModel:
    """Binomial regression without penalty."""
    glm = GeneralizedLinearRegression(family="binomial", link="logit", labelCol=target, regParam=0.0)
    return Pipeline(stages=[_assembler(features), glm]).fit(train)


def logistic_predictions(rows: DataFrame, model: PipelineModel, keep: Sequence[str]) -> DataFrame:
    """Probability and class at 0.5."""
    probability = F.col("prediction")
    predicted = model.transform(rows)
    return predicted.select(*keep, probability.alias("probability"), (probability > 0.5).cast("int").alias("predicted"))
