"""What loads, transforms and record files leave on disk."""

import threading
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from conftest import values
from pyspark.sql import functions as F
from test_warehouse import RUN, battles

from turnlake import schemas
from turnlake.plans import workload
from turnlake.plans.transform import run_transform, transform_rows
from turnlake.plans.warehouse import Warehouse, load_name
from turnlake.session import brief_shuffles, new_folder
from turnlake.sources import records
from turnlake.streaming import load as streaming

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def files(folder, ending):
    return [path for path in Path(folder).rglob(f"*{ending}") if path.name.startswith("part-")]


def test_a_load_leaves_its_tables_only(spark):
    """Staged rows go with the load that made them, also of a replay; what stays is packed."""
    prompts, comparisons = transform_rows("chatbot_arena", battles(spark), RUN)
    root = new_folder(spark, "wh")
    house = Warehouse(spark, root)
    for part, kind in ((prompts, "prompt"), (comparisons, "comparison"), (prompts, "prompt")):
        house.load(part, kind, load_name(1, kind))
        assert not files(f"{root}/stage_{kind}s", "")
    house.snapshot()
    house.refresh_rollups()
    assert house.totals().count() == 2 and house.table("fact_promptexecution").count() == 48
    for name in (*schemas.WAREHOUSE, "dim_prompt_snapshots", "rollups"):
        assert files(f"{root}/{name}", ".zstd.parquet") == files(f"{root}/{name}", ".parquet") != []
    assert spark.conf.get(CLEANUP) == "false"


def test_records_are_packed_and_dealt_without_a_shuffle(spark, tmp_path):
    rows = spark.range(0, 900, 1, 6).select(F.col("id").cast("string").alias("conversation_id"), F.repeat(F.lit("text "), 50).alias("prompt_text"))
    spark.sparkContext.setJobGroup("deal", "deal")
    try:
        n = records.write_parts(rows, f"{tmp_path}/parts", 3, "conversation_id")
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(s) for job in tracker.getJobIdsForGroup("deal") for s in tracker.getJobInfo(job).stageIds]
        assert {stage.numTasks for stage in stages if stage} == {6}  # the rows are written where they are
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert n == len(files(f"{tmp_path}/parts", ".json.gz")) == 18
    back = records.read_records(spark, f"{tmp_path}/parts").select("conversation_id", "prompt_text")
    assert back.count() == 900 and back.exceptAll(rows).isEmpty()


def test_consumed_records_go_as_they_are_loaded(spark, tmp_path):
    prompts, comparisons = transform_rows("chatbot_arena", battles(spark), RUN)
    kept, gone = [], []
    for consumed in (False, True):
        source = f"{tmp_path}/{consumed}"
        each = -(-records.write_parts(prompts, f"{source}/p", 3, "conversation_id") // 2)
        records.write_parts(comparisons, f"{source}/c", 2, "conversation_id")
        house = Warehouse(spark, new_folder(spark, "wh"))
        totals = streaming.load_all(spark, f"{source}/p", f"{source}/c", house, new_folder(spark, "cp"), each, consumed=consumed)
        assert values(totals, "target", "loaded") == [("comparison", 24), ("prompt", 48)]
        (gone if consumed else kept).extend(files(source, ".json.gz"))
    assert kept and not gone


def test_transformed_records_are_packed(spark, tmp_path):
    battles(spark, 6).write.parquet(f"{tmp_path}/in/chatbot_arena/train")
    counts = run_transform(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    assert values(counts) == [("chatbot_arena", "comparison", 6), ("chatbot_arena", "prompt", 12)]
    assert files(f"{tmp_path}/out", ".json.gz") and not files(f"{tmp_path}/out", ".json")


def test_shuffles_are_brief_until_the_last_block_ends(spark):
    """Blocks that overlap in several threads leave the setting as it was."""
    first, second = threading.Event(), threading.Event()

    def one():
        with brief_shuffles(spark):
            first.set()
            second.wait(30)

    with ThreadPoolExecutor(1) as pool:
        running = pool.submit(one)
        first.wait(30)
        with brief_shuffles(spark):
            second.set()
            running.result()
            assert spark.conf.get(CLEANUP) == "true"
    assert spark.conf.get(CLEANUP) == "false"


def test_plain_documents_are_the_labelled_ones_without_a_shuffle(spark, tmp_path):
    """One row for each label of a document; no join, so no shuffle of texts, where none has several."""
    docs = [(i, f"text {i}", "en", "s", 6) for i in range(8)] + [(None, "lost", "en", "s", 4), (3, "text 3", "en", "s", 6)]
    labels = [(1, 1, 0), (2, 0, 1), (9, 1, 1), (None, 1, 0)]
    for name, given in (("once", labels), ("often", [*labels, (2, 1, 1), (2, 1, None), (3, 0, 0), (3, 0, 0), (None, 0, 0)])):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars int").repartition(4).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(given, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        plain = workload.plain_documents(spark, folder)
        assert values(plain) == values(workload.documents(spark, folder).drop("success_score"))
        plan = plain._jdf.queryExecution().executedPlan().toString()
        assert ("Join" in plan) == (name == "often")
