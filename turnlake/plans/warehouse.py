"""The persisted warehouse: one parquet folder per table, one partition per load.

A load overwrites nothing but its own partitions (facts: one per day and load), so a replayed load leaves the same
state behind. It becomes visible with its entry in the log, which is put there last, as a whole and only if no other load
has that number: entries are numbered without gaps in the order in which loads finished, however many run at once, and a
replay keeps its number. Dimension rows of a load are the load's own distinct rows; reading a dimension merges the loads
(the latest finished one wins for prompts and sources). `snapshot` stores the merged dimension and the table of loads in
it, after which reading starts from it and only merges the loads not in that table. The same tables tell which loads a
version of the rollups has counted. Loads are always met by joins; no list of them passes through the driver.

A load also counts its scores by day and model. Such counts add up, so the daily rollup, medians included, is brought up to
date from counts alone.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from turnlake import schemas
from turnlake.operators import rollups, star
from turnlake.operators.quality import accepted, staged
from turnlake.session import PACKED, brief_shuffles, put_if_absent, removed

STAGES = {"prompt": ("stage_prompts", schemas.PROMPT_STAGE), "comparison": ("stage_comparisons", schemas.COMPARISON_STAGE)}
AUDIT = "target string, processed bigint, staged bigint, loaded bigint, rejected bigint"
LOG = "seq bigint, load string"
DAILY_COUNTS = "day date, model_key bigint, success_score double, weight bigint"
FACTS = ("fact_promptexecution", "fact_model_comparison")
KEYS = {
    "dim_prompt": "prompt_key",
    "dim_model": "model_key",
    "dim_task": "task_key",
    "dim_time": "time_key",
    "dim_session": "session_key",
    "dim_source": "source_key",
}
LATEST_WINS = ("dim_prompt", "dim_source")


def load_name(run: int, kind: str, step: int = 0) -> str:
    """A name for the load of one step: a repeated step has the same name. It says nothing about the order of loads."""
    return f"{run:06d}-{'prompt comparison'.split().index(kind)}-{step:08d}"


class Warehouse:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    # --- storage -----------------------------------------------------------------------------

    def _write(self, table: str, load: str, df: DataFrame) -> None:
        df.write.mode("overwrite").options(**PACKED).parquet(f"{self.root}/{table}/load={load}")

    def _write_facts(self, table: str, load: str, facts: DataFrame) -> int:
        """Facts by day and load. The rebalancing makes few files per day and splits a day with a large share of them;
        only the partitions of this load are overwritten.
        """
        seen = Observation()
        day = F.to_date(F.timestamp_micros("time_key"))
        dated = facts.observe(seen, F.count(F.lit(1)).alias("loaded")).withColumns({"day": day, "load": F.lit(load)})
        writer = dated.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.options(**PACKED).partitionBy("day", "load").parquet(f"{self.root}/{table}")
        return seen.get["loaded"]

    def _read(self, folder: str, ddl: str) -> DataFrame:
        """All rows below a folder of partitions; empty before the first one."""
        reader = self.spark.read.schema(ddl).option("basePath", f"{self.root}/{folder}")
        try:
            return reader.parquet(f"{self.root}/{folder}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ddl)

    def log(self) -> DataFrame:
        """`seq, load` of the finished loads."""
        try:
            return self.spark.read.schema(LOG).json(f"{self.root}/log")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LOG)

    def loads(self) -> DataFrame:
        """The audit of all finished loads."""
        return self._read("loads", f"{AUDIT}, load string").join(self.log(), "load")

    def _rows(self, name: str, among: DataFrame | None = None) -> DataFrame:
        """Rows of the finished loads (or of those among the given ones) of a table, with `load` and `seq` (facts: and `day`)."""
        part = "day date, load string" if name in FACTS else "load string"
        loads = self.log() if among is None else self.log().join(among, "load", "left_semi")
        return self._read(name, f"{schemas.WAREHOUSE[name]}, {part}").join(loads, "load")

    # --- versions: derived tables that know which loads they cover ---------------------------------

    def _version(self, kind: str) -> str | None:
        return self._read(f"covered/{kind}", "load string, version string").agg(F.max("version")).first()[0]

    def _new_version(self) -> str:
        """Fresh for every refresh, so that no version in use is overwritten; versions sort by time."""
        return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"

    def _covered(self, kind: str, version: str) -> DataFrame:
        return self._read(f"covered/{kind}", "load string, version string").where(F.col("version") == version).select("load")

    def _freeze(self, version: str) -> DataFrame | None:
        """The loads finished by now, as a table that later loads don't change; None without any."""
        path = f"{self.root}/covering/version={version}"
        self.log().select("load").coalesce(1).write.parquet(path)
        frozen = self.spark.read.schema("load string").parquet(path)
        return None if frozen.isEmpty() else frozen

    def _publish(self, kind: str, version: str, covered: DataFrame) -> None:
        """Make a stored version the current one: the last write of a refresh."""
        covered.coalesce(1).write.parquet(f"{self.root}/covered/{kind}/version={version}")

    # --- tables --------------------------------------------------------------------------------

    def table(self, name: str, among: DataFrame | None = None) -> DataFrame:
        """The current content of a dimension or fact table, or its content as of the given loads."""
        columns = schemas.names(schemas.WAREHOUSE[name])
        rows = self._rows(name, among)
        if name not in KEYS:
            return rows.select(*columns)
        version = self._version(name)
        if version is None:
            return self._merged(name, rows)
        stored = self.spark.read.schema(schemas.WAREHOUSE[name]).parquet(f"{self.root}/{name}_snapshots/version={version}")
        later = self._merged(name, rows.join(self._covered(name, version), "load", "left_anti"))
        merge = star.upsert if name in LATEST_WINS else star.insert_if_absent
        return merge(stored, later, KEYS[name])

    def _merged(self, name: str, rows: DataFrame) -> DataFrame:
        """One row per key: a key's latest load is found on numbers alone, its row by a join. That is a join on the key with a
        condition on the number, so joins on the key that follow don't shuffle the rows once more.
        """
        columns = schemas.names(schemas.WAREHOUSE[name])
        key = KEYS[name]
        if name not in LATEST_WINS:
            return rows.dropDuplicates([key]).select(*columns)
        last = rows.groupBy(F.col(key).alias("_key")).agg(F.max("seq").alias("_last"))
        return rows.join(last, (F.col(key) == F.col("_key")) & (F.col("seq") >= F.col("_last")), "left_semi").select(*columns)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in schemas.WAREHOUSE}

    def snapshot(self, *names: str) -> None:
        """Store the merged dimensions (all, if none is named) as of the loads finished by now; bounds what reading them
        merges. Loads that finish meanwhile are merged when read.
        """
        covered = self._freeze(self._new_version())
        if covered is None:
            return
        with brief_shuffles(self.spark):
            for name in names or KEYS:
                version = self._new_version()
                self.table(name, covered).write.options(**PACKED).parquet(f"{self.root}/{name}_snapshots/version={version}")
                self._publish(name, version, covered)

    def added(self, name: str) -> DataFrame:
        """What each finished load has put into a dimension: its rows, with `load`."""
        return self._rows(name).select("load", *schemas.names(schemas.WAREHOUSE[name]))

    # --- loading -----------------------------------------------------------------------------

    def load(
        self,
        records: DataFrame,
        kind: str,
        load: str,
        policy: str = "longest",
        arrival: tuple[str, ...] = (),
        consumed: str | None = None,
    ) -> dict:
        """Stage, merge and audit one batch of records.

        The cleaned rows are written once as the staging table; dimensions and facts are built from that. A load's staged rows
        go when it is finished, its shuffle files when each table is written, and a folder `consumed`, which holds records that
        nothing else reads, when they are staged.
        """
        with brief_shuffles(self.spark), brief_shuffles(records.sparkSession):
            audit = self._loaded(records, kind, load, policy, arrival, consumed)
            self._commit(load)
            removed(self.spark, f"{self.root}/{STAGES[kind][0]}/load={load}")
        return audit

    def _loaded(
        self, records: DataFrame, kind: str, load: str, policy: str, arrival: tuple[str, ...], consumed: str | None
    ) -> dict:
        """All tables of a load, its audit included: whole but not in the log yet."""
        folder, ddl = STAGES[kind]
        seen = Observation()
        stage = staged(records, kind)
        stage = stage.observe(seen, F.count(F.lit(1)).alias("processed"), F.count_if("rejected").alias("unusable"))
        if set(arrival) - set(schemas.names(ddl)):
            raise ValueError(f"arrival columns must be staged columns: {', '.join(arrival)}")
        self._write(folder, load, star.numbered(accepted(stage)))
        if consumed is not None:
            removed(self.spark, consumed)
        rows = self.spark.read.schema(f"{ddl}, _row bigint").parquet(f"{self.root}/{folder}/load={load}")

        tables = {
            "dim_prompt": lambda: star.dim_prompt(rows, policy, arrival, at_rest=True),
            "dim_time": lambda: star.dim_time(rows),
            "dim_source": lambda: star.dim_source(rows),
        }
        if kind == "prompt":
            fact, facts = "fact_promptexecution", star.execution_facts(rows)
            tables["dim_model"] = lambda: star.dim_model(rows)
            tables["dim_task"] = lambda: star.new_tasks(self._tasks_before(load), star.dim_task(rows))
            tables["dim_session"] = lambda: star.dim_session(rows)
            tables["daily_counts"] = lambda: rollups.daily_counts(facts)
        else:
            fact, facts = "fact_model_comparison", star.comparison_facts(rows)
            tables["dim_model"] = lambda: star.dim_model_of_comparisons(rows)
        # The tables don't depend on each other: their jobs share the cluster. Facts go first, as they and the prompts shuffle texts.
        loaded = self._write_facts(fact, load, facts)
        with ThreadPoolExecutor(len(tables)) as pool:
            written = [pool.submit(lambda name=name, made=made: self._write(name, load, made())) for name, made in tables.items()]
            for one in written:
                one.result()

        processed, unusable = seen.get["processed"], seen.get["unusable"]
        usable = processed - unusable
        audit = {
            "target": kind,
            "processed": processed,
            "staged": usable,
            "loaded": loaded,
            "rejected": unusable + max(usable - loaded, 0),
        }
        self._write("loads", load, self.spark.createDataFrame([tuple(audit.values())], AUDIT))
        return audit

    def _tasks_before(self, load: str) -> DataFrame:
        """The task dimension as the other finished loads have made it: a replay must not find its own tasks."""
        others = self.log().where(F.col("load") != load).select("load")
        return self._rows("dim_task", others).select(*schemas.names(schemas.WAREHOUSE["dim_task"]))

    def _commit(self, load: str) -> int:
        """Enter a load into the log and give its number: the next one that nobody has taken, or, of a replay, its own."""
        mine = F.max(F.when(F.col("load") == load, F.col("seq")))
        known, last = self.log().agg(mine, F.coalesce(F.max("seq"), F.lit(0))).first()
        seq = known
        while seq is None:
            last += 1
            if put_if_absent(self.spark, f"{self.root}/log/{last:012d}.json", json.dumps({"seq": last, "load": load})):
                seq = last
        return seq

    def totals(self) -> DataFrame:
        """Rows processed, loaded and rejected per target."""
        return self.loads().groupBy("target").agg(
            *[F.sum(name).alias(name) for name in ("processed", "staged", "loaded", "rejected")]
        )

    def entity_counts(self) -> DataFrame:
        """(table, rows) of every dimension and fact table."""
        parts = [
            self.table(name).agg(F.lit(name).alias("table"), F.count("*").alias("rows")) for name in schemas.WAREHOUSE
        ]
        counted = parts[0]
        for part in parts[1:]:
            counted = counted.unionByName(part)
        return counted

    # --- rollups -----------------------------------------------------------------------------

    def refresh_rollups(self) -> str | None:
        """Rebuild the five rollups over the loads finished by now as a new version; readers move on when it is whole."""
        version = self._new_version()
        covered = self._freeze(version)
        if covered is None:
            return None
        tables = {name: self.table(name, covered) for name in schemas.WAREHOUSE}
        made = rollups.all_rollups(tables) | {"daily_counts": self._added_up(self._daily_counts(covered))}
        with brief_shuffles(self.spark):
            for name, rollup in made.items():
                rollup.write.options(**PACKED).parquet(f"{self.root}/rollups/{name}/version={version}")
        self._publish("rollups", version, covered)
        return version

    def _daily_counts(self, among: DataFrame | None = None) -> DataFrame:
        loads = self.log() if among is None else self.log().join(among, "load", "left_semi")
        return self._read("daily_counts", f"{DAILY_COUNTS}, load string").join(loads, "load")

    @staticmethod
    def _added_up(counts: DataFrame) -> DataFrame:
        return counts.groupBy("day", "model_key", "success_score").agg(F.sum("weight").alias("weight"))

    def rollup(self, name: str) -> DataFrame:
        """The newest complete version of a rollup."""
        version = self._version("rollups")
        if version is None:
            raise ValueError("no rollups yet: call refresh_rollups first")
        return self.spark.read.parquet(f"{self.root}/rollups/{name}/version={version}")

    def current_daily(self) -> DataFrame:
        """The daily rollup brought up to date: the counts of the stored version and of the loads that it doesn't cover are
        added up, which gives exact medians. No fact is read.
        """
        version = self._version("rollups")
        counts = self._daily_counts()
        if version is not None:
            later = counts.join(self._covered("rollups", version), "load", "left_anti")
            counts = self.rollup("daily_counts").unionByName(later.drop("load", "seq"))
        return rollups.daily_from_counts(self._added_up(counts), self.table("dim_model"))
