"""The warehouse load as a stream of record files, with progress and a daily rollup."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from turnlake.plans.warehouse import Warehouse, load_name
from turnlake.session import removed
from turnlake.sources.records import record_schema

log = logging.getLogger(__name__)


def record_stream(
    spark: SparkSession, path: str, kind: str = "prompt", files_per_trigger: int = 16, consumed: bool = False
) -> DataFrame:
    """Record files as a stream; a micro-batch is the unit that is loaded and audited. `consumed`: files go once their batch
    is done.
    """
    return (
        spark.readStream.schema(record_schema(kind))
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("recursiveFileLookup", "true")
        .option("cleanSource", "delete" if consumed else "off")
        .json(path)
    )


def start_load(stream: DataFrame, kind: str, warehouse: Warehouse, checkpoint: str, run: int = 1) -> StreamingQuery:
    """Load every micro-batch of the stream. A replayed batch has the same load name and overwrites itself."""

    def merge(batch: DataFrame, step: int) -> None:
        audit = warehouse.load(batch, kind, load_name(run, kind, step))
        log.info("load %s step %d: %s", kind, step, audit)

    writer = stream.writeStream.foreachBatch(merge).queryName(f"load_{kind}_{run}")
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def load_all(
    spark: SparkSession,
    prompts: str,
    comparisons: str | None,
    warehouse: Warehouse,
    checkpoints: str,
    files_per_trigger: int = 16,
    run: int = 1,
    consumed: bool = False,
) -> DataFrame:
    """Prompts (must exist), then comparisons (skipped when missing), then merged dimensions and rollups; returns the
    load totals. `consumed`: the records are there for this load only, so they go as they are loaded.
    """
    if not _exists(spark, prompts):
        raise FileNotFoundError(f"prompt records not found: {prompts}")
    sources = [("prompt", prompts)]
    if comparisons and _exists(spark, comparisons):
        sources.append(("comparison", comparisons))
    for kind, path in sources:
        stream = record_stream(spark, path, kind, files_per_trigger, consumed)
        start_load(stream, kind, warehouse, f"{checkpoints}/{kind}", run).awaitTermination()
        if consumed:
            removed(spark, path)
    warehouse.snapshot()
    warehouse.refresh_rollups()
    return warehouse.totals()


class ProgressLog(StreamingQueryListener):
    """Reports every micro-batch: query, batch, rows and rows per second."""

    def __init__(self, report: Callable[[dict], None] = lambda line: log.info("%s", line)) -> None:
        self.report = report

    def onQueryStarted(self, event) -> None:
        self.report({"phase": "started", "query": event.name})

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.report(
            {
                "phase": "running",
                "query": progress.name,
                "batch": progress.batchId,
                "rows": progress.numInputRows,
                "rows_per_second": progress.processedRowsPerSecond,
            }
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.report({"phase": "failed" if event.exception else "finished", "query": str(event.id)})


def daily_counts(executions: DataFrame) -> DataFrame:
    """Attempts and score sums per (day, model) of rows with `timestamp`, `model_name`, `success_score`."""
    scored = executions.where(F.col("success_score").isNotNull() & F.col("timestamp").isNotNull())
    days = scored.groupBy(F.to_date("timestamp").alias("day"), F.coalesce("model_name", F.lit("unknown")).alias("model_name"))
    return days.agg(F.count("*").alias("attempts"), F.sum("success_score").alias("score_sum"))


def start_daily(executions: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Count every micro-batch of a stream of executions into a partition of its own (a replay overwrites it).

    Counts and sums of batches add up, so no state is kept between batches and no row can come too late: there is no
    watermark behind which rows would be lost.
    """

    def keep(batch: DataFrame, step: int) -> None:
        daily_counts(batch).write.mode("overwrite").parquet(f"{folder}/step={step}")

    writer = executions.writeStream.foreachBatch(keep)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def daily_state(spark: SparkSession, folder: str) -> DataFrame:
    """Attempts and mean score per (day, model) over all batches counted so far."""
    parts = spark.read.schema("day date, model_name string, attempts bigint, score_sum double").parquet(folder)
    added = parts.groupBy("day", "model_name").agg(F.sum("attempts").alias("attempts"), F.sum("score_sum").alias("score_sum"))
    return added.select("day", "model_name", "attempts", (F.col("score_sum") / F.col("attempts")).alias("avg_success"))
