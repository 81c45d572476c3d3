"""Raw dataset folders: discovery, file inventory, metadata, reading, profiling."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnlake.operators.adapters import ADAPTERS, adapter_for
from turnlake.session import use_utc


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Path and size of every file below a folder. `content` is not selected, so no file is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.select("path", F.col("length").alias("bytes"))


def human_size(size: Column) -> Column:
    """1536 -> `1.5 KB`."""
    value = size.cast("double")
    chain = F.when(value < 1024, F.format_string("%.1f B", value))
    for power, unit in enumerate(("KB", "MB", "GB"), start=1):
        chain = chain.when(value < 1024 ** (power + 1), F.format_string(f"%.1f {unit}", value / 1024**power))
    return chain.otherwise(F.format_string("%.1f TB", value / 1024**4))


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """(dataset, file, bytes, size) for all files below the datasets folder."""
    parts = F.split(F.substring_index("path", root.rstrip("/") + "/", -1), "/", 2)
    return _files(spark, root).select(
        F.get(parts, F.lit(0)).alias("dataset"), F.get(parts, F.lit(1)).alias("file"), "bytes", human_size(F.col("bytes")).alias("size")
    )


def discover(spark: SparkSession, root: str, selected: Iterable[str] | None = None) -> list[str]:
    """Names of the registered datasets below the folder, sorted; `_` folders and unknown names are skipped."""
    wanted = sorted(ADAPTERS if not selected else set(selected) & set(ADAPTERS))
    present = inventory(spark, root).where(F.col("dataset").isin(wanted)).select("dataset").distinct()
    return sorted(row["dataset"] for row in present.collect())  # at most one row per registered adapter


def metadata(spark: SparkSession, path: str, dataset: str) -> dict[str, str | None]:
    """Name, collection method and version from `train/dataset_info.json`, if there is one."""
    infos = _files(spark, path).where(F.col("path").endswith("/train/dataset_info.json")).limit(1).collect()
    version = None
    if infos:
        schema = "version struct<version_str: string>"
        row = spark.read.schema(schema).option("multiLine", "true").json(infos[0]["path"]).first()
        version = row["version"]["version_str"] if row and row["version"] else None
    return {"dataset_name": dataset, "collection_method": "huggingface_disk", "version": version}


def _arrow_batches(schema: pa.Schema):
    """Reader of Arrow stream shards; missing columns become NULL."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("content"):
                with pa.ipc.open_stream(shard.as_buffer()) as reader:
                    for part in reader:
                        columns = [
                            part.column(field.name).cast(field.type)
                            if field.name in part.schema.names
                            else pa.nulls(part.num_rows, field.type)
                            for field in schema
                        ]
                        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return read


FILES = {"parquet": "*.parquet", "json": "*", "arrow": "*.arrow"}
#: Files of a saved dataset that hold no rows. JSON data has no fixed names, so it is all but these.
METADATA = ("dataset_info.json", "state.json")


def _nothing_else(spark: SparkSession, folder: str, ending: str) -> None:
    """Raises if files of the folder neither end so nor are metadata: their rows would be lost."""
    name = F.substring_index("path", "/", -1)
    about = F.exists(F.split("path", "/"), lambda part: part.isin(*METADATA))
    others = _files(spark, folder).where(~name.endswith(ending) & ~about).select(name.alias("name")).limit(5).collect()
    if others:
        raise ValueError(f"{folder} holds files that aren't *{ending}: {', '.join(sorted(row['name'] for row in others))}")


def read_rows(
    spark: SparkSession, path: str, dataset: str, form: str = "parquet", limit: int | None = None
) -> DataFrame:
    """Raw rows of the `train` split of a dataset folder under its fixed schema. `form` is parquet, json (lines), or
    arrow (a dataset saved to disk as Arrow shards); the metadata files of the folder, such as `dataset_info.json`, are
    left alone, and so are other splits. Any other file of the split is an error, not a gap. Only the first `limit` rows
    if one is given.
    """
    use_utc(spark)
    if form not in FILES:
        raise ValueError(f"unknown form {form!r}")
    ddl = adapter_for(dataset).raw_schema
    reader = spark.read.option("pathGlobFilter", FILES[form]).option("recursiveFileLookup", "true")
    train = f"{path.rstrip('/')}/train"
    if FILES[form] != "*":
        _nothing_else(spark, train, FILES[form].lstrip("*"))
    if form == "arrow":
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(spark.createDataFrame([], ddl).schema)
        # The scan deals out whole shards, which are cut to a few hundred MB when they are saved.
        rows = reader.format("binaryFile").load(train).select("content").mapInArrow(_arrow_batches(schema), ddl)
    else:
        rows = reader.schema(ddl).format(form).load(train).where(~F.col("_metadata.file_name").isin(*METADATA))
    return rows if limit is None else rows.limit(limit)


def profile(df: DataFrame) -> DataFrame:
    """(column, type, nullable, rows, missing) of a table."""
    counts = df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m_{i}") for i, c in enumerate(df.columns)])
    cells = [
        F.struct(
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.lit(field.nullable).alias("nullable"),
            F.col("rows"),
            F.col(f"m_{i}").alias("missing"),
        )
        for i, field in enumerate(df.schema.fields)
    ]
    return counts.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def first_rows(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def spread(scan: DataFrame, *columns: str) -> DataFrame:
    """A file scan with at least one partition per core, hashed on the given (evenly spread) columns.

    Only a scan of a few unsplittable files is redistributed; with many files this is the scan itself.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, *columns) if scan.rdd.getNumPartitions() < cores else scan
