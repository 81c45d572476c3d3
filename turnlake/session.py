"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import functools
import os
import re
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: Tables that hold texts are written with these options: about three fifths of the bytes that the default codec leaves.
PACKED = {"compression": "zstd"}


def local_session(app: str = "turnlake", cpus: int | str = "*", memory: str = "12g") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Every timestamp in the warehouse is UTC, so the session must be too."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: `spark.checkpoint.dir`.

    Only a local-mode session without that setting (tests) gets a folder of its own, which goes with the process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder()


@functools.cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="turnlake-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows written once to the shared folder (with the writer's options, if any) and read back: later passes neither
    recompute them nor depend on the executors that made them.
    """
    path = new_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_halves(df: DataFrame, condition: Column, name: str, **options: str) -> list[tuple[DataFrame, str]]:
    """`stored` in two tables: the rows for which the condition holds, and the others. Each comes with its folder, which may
    go (see `removed`) while the other is still read.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    held = df.withColumn("_holds", F.coalesce(condition, F.lit(False)))
    held.write.options(**options).partitionBy("_holds").parquet(path)
    rows = spark.read.schema(held.schema).parquet(path)
    return [(rows.where(F.col("_holds") == holds).drop("_holds"), f"{path}/_holds={str(holds).lower()}") for holds in (True, False)]


def removed(spark: SparkSession, folder: str) -> None:
    """Removes a folder that nothing reads any more, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discarded(table: DataFrame) -> None:
    """Removes the files of a `stored` table that nothing reads any more."""
    for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
        removed(table.sparkSession, folder)


_brief: dict[str, tuple[int, str]] = {}  # by session: blocks that are open, and the setting before the first of them
_brief_lock = threading.Lock()


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the query that wrote them ends, not only when the driver happens to collect garbage: for work
    in steps that are stored one by one. Blocks may be nested and may run at once in several threads.
    """
    name, session = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", spark._jsparkSession.sessionUUID()
    with _brief_lock:
        n, before = _brief.get(session, (0, spark.conf.get(name)))
        _brief[session] = n + 1, before
        spark.conf.set(name, "true")
    try:
        yield
    finally:
        with _brief_lock:
            n, before = _brief.pop(session)
            if n > 1:
                _brief[session] = n - 1, before
            else:
                spark.conf.set(name, before)


def stored_observed(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """`stored`, with aggregates of the rows that are taken while they are written."""
    seen = Observation()
    rows = stored(df.observe(seen, *(measure.alias(key) for key, measure in measures.items())), name)
    return rows, seen.get


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file as a whole, unless one is there already; of several writers at once, one succeeds.

    The text goes to a file of another name first, which then takes the name: by a hard link on a local disk, elsewhere by
    the store's rename, which refuses a name in use.
    """
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    draft = jvm.org.apache.hadoop.fs.Path(f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    sink = store.create(draft, False)
    try:
        sink.write(text.encode())
    finally:
        sink.close()
    if store.getScheme() == "file":
        names = [store.makeQualified(p).toUri().getPath() for p in (draft, target)]
        try:
            os.link(*names)
            return True
        except FileExistsError:
            return False
        finally:
            store.delete(draft, False)
    if store.rename(draft, target):
        return True
    store.delete(draft, False)
    return False
