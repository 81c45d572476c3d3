"""Raw datasets to prompt and comparison records."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnlake import schemas
from turnlake.operators.adapters import adapter_for
from turnlake.operators.features import comparison_records, prompt_records, with_lineage
from turnlake.operators.language import Profile
from turnlake.session import brief_shuffles
from turnlake.sources import raw, records

OUTPUTS = {"prompt": "prompt_events", "comparison": "model_comparisons"}


def transform_rows(
    dataset: str,
    rows: DataFrame,
    run_ts: dt.datetime,
    method: str | None = "fixture",
    version: str | None = "test",
    profile: Profile | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Prompt and comparison records of one source's rows. One plan per source, no shuffle."""
    adapter = adapter_for(dataset)
    prompts = prompt_records(adapter.prompts(rows, run_ts, dataset), profile)
    prompts = schemas.conform(with_lineage(prompts, run_ts, dataset, method, version), schemas.PROMPT_STAGE)
    if adapter.comparisons is None:
        return prompts, None
    battles = comparison_records(adapter.comparisons(rows, run_ts, dataset), profile)
    battles = schemas.conform(with_lineage(battles, run_ts, dataset, method, version), schemas.COMPARISON_STAGE)
    return prompts, battles


def run_transform(
    spark: SparkSession,
    datasets_root: str,
    output: str,
    datasets: Iterable[str] | None = None,
    limit: int | None = None,
    resume: bool = False,
    form: str = "parquet",
    run_ts: dt.datetime | None = None,
    profile: Profile | None = None,
) -> DataFrame:
    """Transform every discovered dataset and return (dataset_name, record_type, n).

    A language profile, if given, labels the texts without a language label.

    Each source is written to a folder of its own, followed by a row that says it is whole and with which limit. With
    `resume`, sources that a former run finished with the same limit are kept as they are; all others are written anew.
    """
    started = run_ts or dt.datetime.now(dt.timezone.utc)
    output = output.rstrip("/")
    finished = _finished(spark, output)
    done = {key for key, rows in finished.items() if rows == limit} if resume else set()
    found = raw.discover(spark, datasets_root, datasets)
    for dataset in found:
        path = f"{datasets_root.rstrip('/')}/{dataset}"
        about = raw.metadata(spark, path, dataset)
        rows = raw.read_rows(spark, path, dataset, form, limit)
        parts = transform_rows(dataset, rows, started, about["collection_method"], about["version"], profile)
        for kind, part in zip(OUTPUTS, parts):
            if part is not None and (dataset, kind) not in done:
                _mark(spark, output, dataset, kind, False, limit)
                with brief_shuffles(spark):
                    records.write_records(part, f"{output}/{OUTPUTS[kind]}/{dataset}")
                _mark(spark, output, dataset, kind, True, limit)
    return output_counts(spark, output)


def _mark(spark: SparkSession, output: str, dataset: str, kind: str, whole: bool, limit: int | None) -> None:
    """State of one output folder: not whole before it is written, whole afterwards."""
    row = spark.createDataFrame([(whole, limit)], "whole boolean, row_limit bigint")
    row.coalesce(1).write.mode("overwrite").parquet(f"{output}/states/dataset={dataset}/kind={kind}")


def _finished(spark: SparkSession, output: str) -> dict[tuple[str, str], int | None]:
    """(dataset, kind) of the whole outputs (at most two rows per registered adapter) with their row limit."""
    schema = "whole boolean, row_limit bigint, dataset string, kind string"
    try:
        states = spark.read.schema(schema).parquet(f"{output}/states")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {(row["dataset"], row["kind"]): row["row_limit"] for row in states.where("whole").collect()}


def output_counts(spark: SparkSession, output: str) -> DataFrame:
    """Records per dataset and type in an output folder; sources that are not whole are left out."""
    output = output.rstrip("/")
    whole = list(_finished(spark, output))
    parts = []
    for kind in sorted({kind for _, kind in whole}):
        folders = [f"{output}/{OUTPUTS[kind]}/{dataset}" for dataset, of in whole if of == kind]
        read = records.read_records(spark, folders, kind)
        counted = read.groupBy("dataset_name").agg(F.count("*").alias("n"))
        parts.append(counted.select("dataset_name", F.lit(kind).alias("record_type"), "n"))
    if not parts:
        return spark.createDataFrame([], "dataset_name string, record_type string, n bigint")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
