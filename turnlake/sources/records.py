"""Readers and writers of transformed records and result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnlake import schemas
from turnlake.session import brief_shuffles

#: JSON repeats its names in every row, so packed lines take about a quarter of the plain ones.
PACKING = {"json": {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}, "parquet": {"compression": "zstd"}}
STAGE = {"prompt": schemas.PROMPT_STAGE, "comparison": schemas.COMPARISON_STAGE}


def record_schema(kind: str) -> str:
    """Schema for reading records: times as text (checked later), numbers as staged, broken lines kept aside."""
    columns = [
        f"{name} {'string' if name in ('timestamp', 'ingest_timestamp') else type_}"
        for name, type_ in schemas.fields(STAGE[kind])
    ]
    return ", ".join([*columns, "_corrupt_record string"])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw JSON lines for validation."""
    return spark.read.text(path)


def read_records(spark: SparkSession, path: str | list[str], kind: str = "prompt") -> DataFrame:
    """JSON lines as records; blank lines are skipped, unreadable ones end up in `_corrupt_record`."""
    return (
        spark.read.schema(record_schema(kind))
        .option("mode", "PERMISSIVE")
        .option("recursiveFileLookup", "true")
        .json(path)
    )


def write_records(records: DataFrame, path: str, append: bool = False, form: str = "json") -> None:
    writer = records.write.mode("append" if append else "overwrite").options(**PACKING.get(form, {}))
    writer.format(form).save(path)


def write_parts(records: DataFrame, path: str, parts: int, *columns: str) -> int:
    """Records in so many folders, dealt by the columns; returns the number of files. Each task writes its rows where they
    are, one file for each part, so no text is shuffled and no task's share grows with the input.
    """
    part = F.pmod(F.xxhash64(*columns), F.lit(parts))
    with brief_shuffles(records.sparkSession):
        records.withColumn("part", part).write.partitionBy("part").options(**PACKING["json"]).json(path)
    return len(records.sparkSession.read.text(path).inputFiles())


def write_result(df: DataFrame, path: str, form: str = "parquet") -> None:
    """Feature tables (parquet), summaries and rules (json), importances and rules (csv)."""
    writer = df.write.mode("overwrite").format(form)
    (writer.option("header", "true") if form == "csv" else writer).save(path)
