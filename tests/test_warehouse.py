import bz2
import datetime as dt
import gzip
import json
import threading
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pytest
from conftest import values
from pyspark.sql import functions as F

from turnlake import schemas
from turnlake.operators import rollups, star
from turnlake.plans import transform
from turnlake.plans.transform import run_transform, transform_rows
from turnlake.plans.warehouse import Warehouse, load_name
from turnlake.session import new_folder, put_if_absent
from turnlake.sources import raw, records
from turnlake.streaming import load as streaming

RUN = dt.datetime(2024, 5, 1, 8, 0, tzinfo=dt.timezone.utc)


def battles(spark, n=24):
    def side(*texts):
        return [(t, "user" if i == 0 else "assistant") for i, t in enumerate(texts)]

    rows = [
        (f"q{i}", f"m{i % 3}", f"m{(i + 1) % 3}", ["model_a", "model_b", "tie"][i % 3], side(f"prompt {i % 5} must {'x' * (i % 2)}", "yes"),
         side("same", "no"), None, "English", f"2024-01-0{1 + i % 4}T05:00:00Z")
        for i in range(n)
    ]
    return spark.createDataFrame(rows, schemas.RAW_ARENA)


def state(house):
    """All tables but the load-dependent source row."""
    return {name: values(house.table(name)) for name in schemas.WAREHOUSE}


@pytest.fixture(scope="module")
def arena(spark):
    return transform_rows("chatbot_arena", battles(spark), RUN)


def test_reload_changes_nothing_and_snapshot_keeps_the_state(spark, arena):
    prompts, comparisons = arena
    house = Warehouse(spark, new_folder(spark, "wh"))
    audit = house.load(prompts, "prompt", load_name(1, "prompt"))
    assert audit == {"target": "prompt", "processed": 48, "staged": 48, "loaded": 48, "rejected": 0}
    house.load(comparisons, "comparison", load_name(1, "comparison"))
    before = state(house)
    house.load(prompts, "prompt", load_name(1, "prompt"))
    assert state(house) == before
    for name in ("dim_prompt", "dim_model"):
        house.snapshot(name)
    assert state(house) == before
    assert house.table("dim_model").count() == 3 and house.table("fact_model_comparison").count() == 24
    assert dict(values(house.entity_counts())) == {name: len(rows) for name, rows in before.items()}
    house.refresh_rollups()
    board = house.rollup("model_performance_arena")
    assert values(board, "model_name") == [("m0",), ("m1",), ("m2",)] and sum(r["attempts"] for r in board.collect()) == 48


def test_later_load_updates_prompts_and_keeps_keys(spark, arena):
    prompts, _ = arena
    house = Warehouse(spark, new_folder(spark, "wh"))
    house.load(prompts, "prompt", load_name(1, "prompt"))
    keys = values(house.table("dim_prompt"), "prompt_key")
    house.snapshot("dim_prompt")
    house.load(prompts.withColumns({"language": F.lit("xx"), "version": F.lit("v2")}), "prompt", load_name(2, "prompt"))
    dim = house.table("dim_prompt")
    assert values(dim, "prompt_key") == keys and {r["language"] for r in dim.collect()} == {"xx"}
    assert values(house.table("dim_source"), "version") == [("v2",)]
    assert house.table("fact_promptexecution").count() == 96  # a new load appends its facts
    assert house.totals().first()["loaded"] == 96


def test_daily_rollup_follows_later_loads(spark, arena):
    prompts, _ = arena
    house = Warehouse(spark, new_folder(spark, "wh"))
    with pytest.raises(ValueError, match="no rollups"):
        house.rollup("daily_model_success")
    house.load(prompts, "prompt", load_name(1, "prompt"))
    assert house.current_daily().count() > 0
    house.refresh_rollups()
    stored = values(house.rollup("daily_model_success"))
    assert values(house.current_daily()) == stored
    late = prompts.where("timestamp >= timestamp'2024-01-03'").withColumn("success_score", F.lit(0.25))
    house.load(late, "prompt", load_name(2, "prompt"))
    current = values(house.current_daily())
    assert values(house.rollup("daily_model_success")) == stored != current
    house.refresh_rollups()
    assert values(house.rollup("daily_model_success")) == current


def test_loads_count_in_the_order_they_finish(spark, arena):
    """A load whose name sorts below an earlier one still comes later: for dimensions, snapshots and the daily rollup."""
    prompts, comparisons = arena
    house = Warehouse(spark, new_folder(spark, "wh"))
    house.load(comparisons.withColumn("language", F.lit("old")), "comparison", load_name(9, "comparison"))
    house.snapshot()
    house.load(prompts.where("timestamp < timestamp'2024-01-02'").withColumn("language", F.lit("mid")), "prompt", load_name(2, "prompt"))
    first = house.refresh_rollups()
    house.load(prompts.where("timestamp >= timestamp'2024-01-02'").withColumn("language", F.lit("new")), "prompt", load_name(1, "prompt"))
    dim = house.table("dim_prompt")
    late = prompts.where("timestamp >= timestamp'2024-01-02'").select("prompt_hash").distinct()
    assert dim.count() == prompts.select("prompt_hash").distinct().count()
    assert {r["language"] for r in dim.join(late, "prompt_hash", "left_semi").collect()} == {"new"}
    assert house.current_daily().select("day").distinct().count() == 4
    assert house.refresh_rollups() > first
    assert values(house.rollup("daily_model_success")) == values(house.current_daily())
    before = state(house)
    house.snapshot()
    assert state(house) == before
    house.load(comparisons.withColumn("language", F.lit("old")), "comparison", load_name(9, "comparison"))  # a replay
    assert state(house) == before
    assert values(house.loads(), "load", "seq") == [(load_name(1, "prompt"), 3), (load_name(2, "prompt"), 2), (load_name(9, "comparison"), 1)]


def test_unfinished_load_is_invisible(spark, arena):
    house = Warehouse(spark, new_folder(spark, "wh"))
    house._write_facts("fact_promptexecution", load_name(1, "prompt"), star.execution_facts(arena[0]))
    assert house.table("fact_promptexecution").count() == 0


def test_stream_equals_batch(spark, arena):
    prompts, comparisons = arena
    source = new_folder(spark, "records")
    records.write_records(prompts.repartition(5), f"{source}/p")
    records.write_records(comparisons, f"{source}/c")
    batch = Warehouse(spark, new_folder(spark, "wh"))
    batch.load(records.read_records(spark, f"{source}/p"), "prompt", load_name(1, "prompt"))
    batch.load(records.read_records(spark, f"{source}/c", "comparison"), "comparison", load_name(1, "comparison"))
    streamed = Warehouse(spark, new_folder(spark, "wh"))
    seen = []
    listener = streaming.ProgressLog(seen.append)
    spark.streams.addListener(listener)
    checkpoints = new_folder(spark, "cp")
    totals = streaming.load_all(spark, f"{source}/p", f"{source}/c", streamed, checkpoints, files_per_trigger=2)
    spark.streams.removeListener(listener)
    assert values(totals, "target", "loaded", "rejected") == [("comparison", 24, 0), ("prompt", 48, 0)]
    assert streamed.loads().where("target = 'prompt'").count() == 3
    assert state(streamed) == state(batch)
    assert {line["phase"] for line in seen} >= {"started", "running"}
    again = streaming.load_all(spark, f"{source}/p", None, streamed, checkpoints)
    assert values(again, "target", "loaded") == [("comparison", 24), ("prompt", 48)]
    with pytest.raises(FileNotFoundError):
        streaming.load_all(spark, f"{source}/nothing", None, streamed, checkpoints)


def test_rejects_are_audited(spark):
    rows = [("c", "text", None), ("c", "", ""), ("c", None, " ")]
    df = spark.createDataFrame(rows, "conversation_id string, prompt_text string, prompt_hash string")
    df = df.withColumns({"turn_number": F.lit(1), "tokens": F.lit(1)})
    house = Warehouse(spark, new_folder(spark, "wh"))
    audit = house.load(df, "prompt", load_name(1, "prompt"))
    assert (audit["processed"], audit["staged"], audit["loaded"], audit["rejected"]) == (3, 1, 1, 2)


def test_first_variant_policy(spark):
    rows = [("c2", 1, "a  b", "h"), ("c1", 1, "a b", "h")]
    df = spark.createDataFrame(rows, "conversation_id string, turn_number int, prompt_text string, prompt_hash string").withColumn("tokens", F.lit(1))
    house = Warehouse(spark, new_folder(spark, "wh"))
    house.load(df, "prompt", load_name(1, "prompt"), "first", ("conversation_id", "turn_number"))
    assert values(house.table("dim_prompt"), "prompt_text") == [("a b",)]


def test_transform_run_with_discovery_and_resume(spark, tmp_path):
    root, out = f"{tmp_path}/datasets", f"{tmp_path}/out"
    battles(spark, 6).write.parquet(f"{root}/chatbot_arena/train")
    battles(spark, 9).write.parquet(f"{root}/chatbot_arena/test")
    battles(spark, 6).write.parquet(f"{root}/unknown_set/train")
    spark.createDataFrame([("a", "do it", None, True)], schemas.RAW_LIBRARY).write.parquet(f"{root}/prompt_library/train")
    info = tmp_path / "datasets/prompt_library/train/dataset_info.json"
    info.write_text(json.dumps({"version": {"version_str": "1.2.3"}}, indent=2))
    assert raw.discover(spark, root) == ["chatbot_arena", "prompt_library"]
    assert raw.discover(spark, root, ["prompt_library", "other"]) == ["prompt_library"]
    assert raw.metadata(spark, f"{root}/prompt_library", "prompt_library")["version"] == "1.2.3"
    assert raw.metadata(spark, f"{root}/chatbot_arena", "chatbot_arena")["version"] is None
    counts = run_transform(spark, root, out, limit=4)
    library = ("prompt_library", "prompt", 1)
    assert values(counts) == [("chatbot_arena", "comparison", 4), ("chatbot_arena", "prompt", 8), library]
    assert values(run_transform(spark, root, out, limit=4, resume=True)) == values(counts)
    # A run with a limit is not a finished run without one.
    whole = [("chatbot_arena", "comparison", 6), ("chatbot_arena", "prompt", 12), library]
    assert values(run_transform(spark, root, out, resume=True)) == whole
    # Finished outputs are kept; one that was never marked as whole is written again.
    records.write_records(spark.createDataFrame([("x", "chatbot_arena")], "conversation_id string, dataset_name string"), f"{out}/prompt_events/chatbot_arena")
    assert values(run_transform(spark, root, out, resume=True))[1] == ("chatbot_arena", "prompt", 1)
    transform._mark(spark, out, "chatbot_arena", "prompt", False, None)
    assert values(transform.output_counts(spark, out)) == [whole[0], library]
    assert values(run_transform(spark, root, out, resume=True)) == whole


def test_arrow_shards(spark, tmp_path):
    folder = tmp_path / "prompt_library" / "train"
    folder.mkdir(parents=True)
    for shard in range(3):
        table = pa.table({"prompt": [f"p{shard}", "q"], "act": ["x", None], "extra": [1, 2]})
        with pa.OSFile(str(folder / f"data-{shard:05d}.arrow"), "wb") as sink, pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
    rows = raw.read_rows(spark, str(tmp_path / "prompt_library"), "prompt_library", "arrow")
    assert rows.count() == 6 and values(rows, "act", "prompt", "for_devs")[0] == ("x", "p0", None)
    with pytest.raises(ValueError, match="unknown form"):
        raw.read_rows(spark, str(tmp_path), "prompt_library", "xml")


@pytest.mark.parametrize("form", ["parquet", "arrow"])
def test_other_files_of_a_split_are_an_error(spark, tmp_path, form):
    folder = tmp_path / "prompt_library" / "train"
    folder.mkdir(parents=True)
    (folder / "dataset_info.json").write_text("{}")
    (folder / f"rows.{form}.gz").write_bytes(b"x")
    with pytest.raises(ValueError, match=f"rows.{form}.gz"):
        raw.read_rows(spark, str(tmp_path / "prompt_library"), "prompt_library", form)


def test_json_lines(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"conversation_id": "c", "tokens": 3}\n\n{broken\n{"conversation_id": "d"}\n')
    rows = records.read_records(spark, str(tmp_path / "r.jsonl")).select("conversation_id", "tokens", "_corrupt_record").collect()
    assert [tuple(r) for r in rows] == [("c", 3, None), (None, None, "{broken"), ("d", None, None)]
    for form in ("parquet", "json", "csv"):
        records.write_result(spark.range(3), str(tmp_path / form), form)
        assert spark.read.format(form).option("header", "true").load(str(tmp_path / form)).count() == 3


def test_profile_and_inventory(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert values(raw.profile(df), "column", "rows", "missing") == [("a", 2, 0), ("b", 2, 1)]
    assert raw.first_rows(df, 1).count() == 1
    (tmp_path / "one").mkdir()
    (tmp_path / "one/data.bin").write_bytes(b"x" * 1536)
    assert values(raw.inventory(spark, str(tmp_path))) == [("one", "data.bin", 1536, "1.5 KB")]
    sizes = spark.createDataFrame([(5,), (3 * 1024**2,), (5 * 1024**4,)], "n long").select(raw.human_size(F.col("n")).alias("s"))
    assert [r["s"] for r in sizes.collect()] == ["5.0 B", "3.0 MB", "5.0 TB"]


def test_daily_stream(spark, tmp_path):
    """Files whose days go back in time: no row is too late."""
    rows = [(f"2024-0{1 + i % 3}-01 0{i % 9}:00:00", f"m{i % 2}" if i % 5 else None, (i % 3) / 2) for i in range(60)]
    df = spark.createDataFrame(rows, "t string, model_name string, success_score double").selectExpr("cast(t AS timestamp) AS timestamp", "model_name", "success_score")
    for month in (3, 2, 1):
        df.where(F.month("timestamp") == month).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    streaming.start_daily(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    expected = df.groupBy(F.to_date("timestamp").alias("day"), F.coalesce("model_name", F.lit("unknown")).alias("model_name")).agg(
        F.count("*").alias("attempts"), F.avg("success_score").alias("avg_success")
    )
    assert values(streaming.daily_state(spark, f"{tmp_path}/out")) == values(expected)


def test_json_reads_every_data_file_whatever_its_name(spark, tmp_path):
    folder = tmp_path / "prompt_library" / "train"
    (folder / "deep").mkdir(parents=True)
    packed = {"part-0.json.gz": gzip.compress, "x.json.gz": gzip.compress, "y.jsonl.bz2": bz2.compress}
    names = [*packed, "train.json", "rows.ndjson", "plain", "a.jsonl", "deep/data-1.json"]
    for name in names:
        (folder / name).write_bytes(packed.get(name, bytes)(json.dumps({"prompt": name, "act": "x"}).encode() + b"\n"))
    (folder / "dataset_info.json").write_text(json.dumps({"version": {"version_str": "1.2.3"}}, indent=2))
    (folder / "state.json").write_text(json.dumps({"_data_files": [{"filename": "a"}]}))
    rows = raw.read_rows(spark, str(tmp_path / "prompt_library"), "prompt_library", "json")
    assert sorted(r["prompt"] for r in rows.collect()) == sorted(names)
    assert raw.read_rows(spark, str(tmp_path / "prompt_library"), "prompt_library", "json", 3).count() == 3


def test_one_writer_of_many_gets_a_name(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: put_if_absent(spark, f"{tmp_path}/log/0001.json", f"writer {i}"), range(16)))
    assert won.count(True) == 1
    assert (tmp_path / "log/0001.json").read_text() == f"writer {won.index(True)}"
    assert [p.name for p in (tmp_path / "log").iterdir() if not p.name.endswith(".crc")] == ["0001.json"]
    assert put_if_absent(spark, f"file://{tmp_path}/a b/x%20y", "z") and (tmp_path / "a b/x%20y").read_text() == "z"


def test_concurrent_loads_get_numbers_of_their_own(spark, arena):
    """Readers see whole loads only, whatever else is being written."""
    prompts, comparisons = arena
    house = Warehouse(spark, new_folder(spark, "wh"))
    jobs = [(prompts, "prompt", load_name(i, "prompt")) for i in range(3)] + [(comparisons, "comparison", load_name(9, "comparison"))]
    seen, done = [], threading.Event()

    def watch():
        while not done.is_set():
            seen.append((house.log().count(), house.table("fact_promptexecution").count() + house.table("fact_model_comparison").count()))

    watcher = threading.Thread(target=watch)
    watcher.start()
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda job: house.load(*job), jobs))
    done.set()
    watcher.join()
    assert sorted(r["seq"] for r in house.loads().collect()) == [1, 2, 3, 4]
    assert {n for _, n in seen} <= {48 * a + 24 * b for a in range(4) for b in range(2)}
    assert house.table("fact_promptexecution").count() == 144 and house.totals().count() == 2


def test_a_load_adds_new_tasks_only(spark, arena):
    prompts, _ = arena
    house = Warehouse(spark, new_folder(spark, "wh"))
    house.load(prompts, "prompt", load_name(1, "prompt"))
    tasks = house.table("dim_task").count()
    more = prompts.withColumn("domain", F.when(F.col("turn_number") == 1, "d"))
    house.load(more, "prompt", load_name(2, "prompt"))
    added = {r["load"]: r["count"] for r in house.added("dim_task").groupBy("load").count().collect()}
    assert added == {load_name(1, "prompt"): tasks, load_name(2, "prompt"): house.table("dim_task").count() - tasks}
    before = values(house.added("dim_task"))
    house.load(prompts, "prompt", load_name(1, "prompt"))  # a replay finds its own tasks new again
    assert values(house.added("dim_task")) == before


def test_current_daily_reads_no_fact(spark, arena):
    house = Warehouse(spark, new_folder(spark, "wh"))
    house.load(arena[0], "prompt", load_name(1, "prompt"))
    house.refresh_rollups()
    house.load(arena[0], "prompt", load_name(2, "prompt"))
    assert "fact_" not in "".join(house.current_daily().inputFiles())
    facts, models = house.table("fact_promptexecution"), house.table("dim_model")
    assert values(house.current_daily()) == values(rollups.daily_model_success(facts, models))
