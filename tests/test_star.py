import pytest
from conftest import values
from pyspark.sql import functions as F

from turnlake import schemas
from turnlake.operators import rollups, star

DDL = (
    "conversation_id string, turn_number int, prompt_text string, prompt_hash string, prompt_length int, tokens int, "
    "response_tokens int, model_name string, task_type string, language string, programming_lang string, task_category string, "
    "timestamp timestamp, session_id string, dataset_name string, batch_id string, ingest_timestamp timestamp, "
    "success_score double, latency double"
)


def stage(spark, rows):
    base = dict.fromkeys(schemas.names(schemas.PROMPT_STAGE))
    names = schemas.names(DDL)
    text = "struct<" + ", ".join(f"{n}: {'string' if t == 'timestamp' else t}" for n, t in schemas.fields(DDL)) + ">"
    full = [tuple((base | {"turn_number": 1, "tokens": 4, "conversation_id": "c"} | r).get(n) for n in names) for r in rows]
    return schemas.conform(spark.createDataFrame(full, text), schemas.PROMPT_STAGE)


def test_longest_variant_then_smallest_text_wins(spark):
    rows = [
        {"prompt_hash": "h1", "prompt_text": "ab", "prompt_length": 2},
        {"prompt_hash": "h1", "prompt_text": "a  b", "prompt_length": 4, "language": "en"},
        {"prompt_hash": "h1", "prompt_text": "a \tb", "prompt_length": 4},
        {"prompt_hash": "h1", "prompt_text": "zzz", "prompt_length": None},
        {"prompt_hash": None, "prompt_text": "x"},
    ]
    dim = star.dim_prompt(stage(spark, rows))
    assert dim.columns == schemas.names(schemas.DIM_PROMPT)
    row = dim.collect()
    assert len(row) == 1 and row[0]["prompt_text"] == "a \tb"
    assert (row[0]["prompt_type"], row[0]["type"], row[0]["language"], row[0]["contains_code"]) == ("standard", "standard", "unknown", False)
    first = star.dim_prompt(stage(spark, rows).withColumn("batch_id", F.col("prompt_text")), "first", ["batch_id"])
    assert values(first, "prompt_text") == [("a \tb",)]
    with pytest.raises(ValueError, match="unknown policy"):
        star.dim_prompt(stage(spark, rows), "last")


def test_task_keys_tell_null_positions_apart(spark):
    rows = [
        {"prompt_hash": "h", "task_type": "a"},
        {"prompt_hash": "h", "language": "a"},
        {"prompt_hash": "h", "task_type": "a"},
        {"prompt_hash": "h", "task_type": "a", "language": "null"},
        {"prompt_hash": "h"},
    ]
    tasks = star.dim_task(stage(spark, rows))
    assert values(tasks, "task_type", "language") == [("a", "null"), ("a", None), (None, "a")]
    known = tasks.where("language IS NULL")
    assert values(star.new_tasks(known, tasks), "task_type", "language") == [("a", "null"), (None, "a")]


def test_upserts(spark):
    current = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 9), ("c", 3)], "k string, v int")
    assert values(star.upsert(current, new, "k")) == [("a", 1), ("b", 9), ("c", 3)]
    assert values(star.insert_if_absent(current, new, "k")) == [("a", 1), ("b", 2), ("c", 3)]


def test_latest_source_wins_with_nulls_last(spark):
    rows = [
        {"dataset_name": "d", "ingest_timestamp": "2024-01-01 00:00:00", "batch_id": "old"},
        {"dataset_name": "d", "ingest_timestamp": "2024-01-02 00:00:00", "batch_id": "new"},
        {"dataset_name": "d", "ingest_timestamp": None, "batch_id": "none"},
        {"dataset_name": "", "batch_id": "x"},
    ]
    assert values(star.dim_source(stage(spark, rows)), "dataset_name", "batch_id") == [("d", "new")]


def test_keys_in_place_equal_keys_by_lookup(spark):
    rows = [
        {"prompt_hash": f"h{i % 3}", "prompt_text": "t", "model_name": None if i % 4 == 0 else f"m{i % 2}",
         "task_type": None if i % 5 == 0 else "a", "language": None if i % 2 else "en", "timestamp": None if i % 7 == 0 else f"2024-01-0{1 + i % 3} 00:00:00",
         "session_id": f"s{i}", "dataset_name": "d", "success_score": 0.5}
        for i in range(20)
    ]
    staged = stage(spark, rows)
    dims = {
        "dim_prompt": star.dim_prompt(staged), "dim_model": star.dim_model(staged), "dim_task": star.dim_task(staged),
        "dim_time": star.dim_time(staged), "dim_session": star.dim_session(staged), "dim_source": star.dim_source(staged),
    }
    assert values(star.execution_facts(staged)) == values(star.looked_up_execution_facts(staged, dims))
    for name, key in (("dim_prompt", "prompt_key"), ("dim_task", "task_key"), ("dim_time", "time_key")):
        assert dims[name].count() == dims[name].select(key).distinct().count()


def comparison(spark, rows):
    names = ["conversation_id", "prompt_text", "prompt_hash", "model_a", "model_b", "winner", "dataset_name"]
    return schemas.conform(spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)), schemas.COMPARISON_STAGE)


def test_comparison_facts(spark):
    rows = [
        ("c1", "p", "h", "a", "b", "MODEL_A", "d"),
        ("c2", "p", "h", "a", "b", "tie", "d"),
        ("c3", "p", "h", "", "b", "model_b", "d"),
        ("c4", "p", None, "a", "b", "model_b", "d"),
    ]
    staged = comparison(spark, rows)
    facts = star.comparison_facts(staged)
    names = {r["model_key"]: r["model_name"] for r in star.dim_model_of_comparisons(staged).collect()}
    got = [(r["conversation_id"], names[r["model_a_key"]], names.get(r["winner_model_key"])) for r in facts.collect()]
    assert sorted(got) == [("c1", "a", "a"), ("c2", "a", None)]
    dims = {"dim_prompt": star.dim_prompt(staged), "dim_model": star.dim_model_of_comparisons(staged),
            "dim_time": star.dim_time(staged), "dim_source": star.dim_source(staged)}
    assert values(facts) == values(star.looked_up_comparison_facts(staged, dims))


def test_rollups_and_extract(spark):
    rows = [
        {"prompt_hash": "h", "prompt_text": "t", "prompt_length": 1, "model_name": m, "success_score": s, "dataset_name": d,
         "timestamp": t, "programming_lang": g, "tokens": 10, "response_tokens": r, "latency": x}
        for m, s, d, t, g, r, x in [
            ("m1", 1.0, "My Arena", "2024-01-01 23:59:59", "sql", 4, 2.0),
            ("m1", 0.0, "My Arena", "2024-01-01 00:00:00", "sql", None, None),
            ("m1", 0.5, "other", "2024-01-02 00:00:00", None, None, 4.0),
            (None, 0.5, "ARENA", "2024-01-01 05:00:00", "go", None, None),
            ("unknown", 1.0, "x", "2024-01-01 06:00:00", "go", None, None),
            ("m2", None, "My Arena", "2024-01-01 00:00:00", "sql", None, None),
            ("m1", 1.0, "x", None, None, None, None),
        ]
    ]
    staged = stage(spark, rows)
    tables = {
        "fact_promptexecution": star.execution_facts(staged), "dim_prompt": star.dim_prompt(staged),
        "dim_model": star.dim_model(staged), "dim_task": star.dim_task(staged), "dim_source": star.dim_source(staged),
    }
    got = rollups.all_rollups(tables)
    daily = got["daily_model_success"].withColumn("day", F.col("day").cast("string"))
    assert values(daily) == [
        ("2024-01-01", "m1", 2, 0.5, 0.5), ("2024-01-01", "unknown", 2, 0.75, 0.75), ("2024-01-02", "m1", 1, 0.5, 0.5),
    ]
    assert values(got["model_performance_arena"]) == [("m1", 2, 0.5, 0.5)]
    assert values(got["language_performance"]) == [("go", 2, 0.75, 0.75), ("sql", 2, 0.5, 0.5)]
    assert values(got["prompt_feature_impact"], "cnt", "median_success") == [(6, 0.75)]
    assert values(got["top_prompt_templates"], "prompt_hash", "uses", "median_success") == [("h", 6, 0.75)]
    efficiency = rollups.model_efficiency(tables["fact_promptexecution"], tables["dim_model"])
    row = efficiency.where("model_name = 'm1'").first()
    assert (row["avg_latency"], row["avg_tokens"], row["avg_tokens_once"], row["execution_count"], row["latency_samples"]) == (3.0, 11.0, 10.0, 4, 2)
    extract = star.training_extract(tables["fact_promptexecution"], tables["dim_prompt"], tables["dim_model"], tables["dim_task"])
    assert extract.count() == 6 and extract.where("execution_status = 'failure'").count() == 1


def test_prompts_keep_their_rows_when_files_are_read_in_other_pieces(spark):
    """A scan's pieces follow the cores and settings at hand when it runs, which may change between two reads."""
    rows = [{"prompt_hash": f"h{i}", "prompt_text": f"text {i}", "prompt_length": i, "language": f"l{i}"} for i in range(40)]
    dim = star.dim_prompt(stage(spark, rows).repartition(8))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = values(dim, "prompt_hash", "prompt_text", "language")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found == sorted((f"h{i}", f"text {i}", f"l{i}") for i in range(40))
