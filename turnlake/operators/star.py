"""Star schema: dimensions and facts from staged rows, upserts and star joins.

Keys are functions of the natural key, so a load assigns them without any lookup join and every rerun gives the
same ones. Prompts and sessions use their 256-bit hash and times their microsecond, which cannot collide in
practice; the name-like dimensions (models, tasks, sources) use a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from turnlake import schemas
from turnlake.functions.messages import winner_model
from turnlake.functions.text import sha256
from turnlake.functions.times import calendar
from turnlake.operators.ordered import HASH_BITS, ORDER_BITS, first_rows, hash_order
from turnlake.session import stored

TASK_KEYS = ("task_type", "domain", "language", "programming_lang", "difficulty", "benchmark_id", "category")


# --- keys ------------------------------------------------------------------------------------


def name_key(name: Column) -> Column:
    """Key of a model or source; NULL for a missing or empty name."""
    return F.when(name != "", F.xxhash64(name))


def time_key(ts: Column) -> Column:
    return F.unix_micros(ts)


def session_of(df: DataFrame) -> Column:
    given = F.nullif(F.col("session_id"), F.lit("")) if "session_id" in df.columns else F.lit(None).cast("string")
    return F.coalesce(given, sha256(F.col("conversation_id")))


def task_columns(category: str = "task_category") -> list[Column]:
    return [F.col(category if name == "category" else name).alias(name) for name in TASK_KEYS]


def task_key(category: str = "task_category") -> Column:
    """Key over all seven attributes; explicit nulls keep (NULL, 'a') apart from ('a', NULL)."""
    described = F.xxhash64(F.to_json(F.struct(*task_columns(category)), {"ignoreNullFields": "false"}))
    return F.when(F.coalesce(*[F.col(c) for c in _task_sources(category)]).isNotNull(), described)


def _task_sources(category: str) -> list[str]:
    return [category if name == "category" else name for name in TASK_KEYS]


# --- dimensions ------------------------------------------------------------------------------


PROMPT_DEFAULTS = {
    "prompt_text": ("''",),
    "prompt_type": ("'standard'",),
    "contains_code": ("false",),
    "contains_examples": ("false",),
    "contains_constraints": ("false",),
    "language": ("'unknown'",),
    "complexity_score": ("0.0D",),
    "length": ("prompt_length",),
    "token_count": ("token_estimate",),
    "type": ("prompt_type", "'standard'"),
}


def numbered(stage: DataFrame) -> DataFrame:
    """Rows about to be written, with the number by which `dim_prompt` finds them again: fixed once written."""
    return stage.withColumn("_row", F.monotonically_increasing_id())


def dim_prompt(
    stage: DataFrame,
    policy: str = "longest",
    arrival: Sequence[str] = (),
    only: Sequence[str] | None = None,
    at_rest: bool = False,
) -> DataFrame:
    """One row per prompt hash, with all attributes or `only` some.

    `longest`: the longest variant, then the smallest text. `first`: the first one in the order of the `arrival`
    columns. The winner is found on narrow rows, the distinct variants of a hash, with a digest in place of the text.
    Texts are fetched by row: those of the variants that tie, where a hash has several, and then those of the winners.

    The stage is read a few times, by row number, so it is written first, numbered, unless it is a table of files with the
    numbers in it (`at_rest`; see `numbered`). Numbers that a scan gives would change with the cores that are there.
    """
    named = [name for name in schemas.names(schemas.DIM_PROMPT) if name not in ("prompt_key", "prompt_hash")]
    attributes = [name for name in named if only is None or name in only]
    if policy == "longest":
        order = {"_order0": F.coalesce(-F.col("prompt_length"), F.lit(2**31 - 1))}
    elif policy == "first":
        order = {f"_order{i}": F.col(name) for i, name in enumerate(arrival)}
    else:
        raise ValueError(f"unknown policy {policy!r}")
    carried = [name for name in attributes if name != "prompt_text"]
    kept = stage.where(F.col("prompt_hash").isNotNull())
    if not at_rest:
        needed = {"prompt_hash", "prompt_text", "prompt_length", *attributes, *arrival}
        needed |= {d for name in attributes for d in PROMPT_DEFAULTS.get(name, ()) if d in stage.columns}
        kept = stored(numbered(kept.select(*[name for name in stage.columns if name in needed])), "prompt-stage")
    rows = kept.select("prompt_hash", *[c.alias(n) for n, c in order.items()], *carried, F.xxhash64("prompt_text").alias("_digest"), "_row")
    variants = rows.groupBy("prompt_hash", *order, "_digest", *carried).agg(F.min("_row").alias("_row"))
    if policy == "longest":  # a hash has few lengths
        first = W.partitionBy("prompt_hash")
        variants = variants.withColumn("_best", F.min("_order0").over(first)).where("_order0 = _best").drop("_best")
    else:
        best = rows.groupBy("prompt_hash").agg(F.min(F.struct(*order)).alias("best")).select("prompt_hash", "best.*")
        keys = ("prompt_hash", *order)
        best = best.withColumnsRenamed({name: f"_best_{name}" for name in keys})
        same = [F.col(name).eqNullSafe(F.col(f"_best_{name}")) for name in keys]
        variants = variants.join(best, reduce(Column.__and__, same), "left_semi")
    place = F.row_number().over(W.partitionBy("prompt_hash", "_digest").orderBy(*carried, "_row"))
    variants = variants.drop(*order).withColumn("_place", place).where("_place = 1").drop("_place")
    several = (F.min("_digest").over(W.partitionBy("prompt_hash")) != F.max("_digest").over(W.partitionBy("prompt_hash")))
    variants = stored(variants.withColumn("_several", several), "prompt-variants")
    tied = stored(variants.where("_several"), "prompt-ties").join(kept.select("_row", "prompt_text"), "_row")
    least = F.row_number().over(W.partitionBy("prompt_hash").orderBy("prompt_text", *carried))
    tied = tied.withColumn("_place", least).where("_place = 1").select(variants.columns)
    chosen = variants.where("not _several").unionByName(tied)
    if "prompt_text" in attributes:
        chosen = chosen.join(kept.select("_row", "prompt_text"), "_row")

    def filled(name: str) -> str:
        usable = [d for d in PROMPT_DEFAULTS.get(name, ()) if d not in named or d in attributes]
        return f"coalesce({', '.join([name, *usable])}) AS {name}"

    return chosen.selectExpr("prompt_hash AS prompt_key", "prompt_hash", *map(filled, attributes)).select(
        *[name for name in schemas.names(schemas.DIM_PROMPT) if name in ("prompt_key", "prompt_hash", *attributes)]
    )


def _models(names: DataFrame) -> DataFrame:
    filled = names.where(F.col("model_name") != "").distinct()
    return schemas.conform(filled.withColumn("model_key", name_key(F.col("model_name"))), schemas.DIM_MODEL)


def dim_model(stage: DataFrame) -> DataFrame:
    return _models(stage.select("model_name"))


def dim_model_of_comparisons(stage: DataFrame) -> DataFrame:
    """Union of both contestants and the winner, exploded in one pass instead of three scans."""
    winner = winner_model("winner", "model_a", "model_b")
    return _models(stage.select(F.explode(F.array("model_a", "model_b", winner)).alias("model_name")))


def dim_task(stage: DataFrame) -> DataFrame:
    """Distinct task descriptions with at least one attribute set."""
    described = stage.select(task_key().alias("task_key"), *task_columns())
    return described.where(F.col("task_key").isNotNull()).dropDuplicates(["task_key"])


def dim_time(stage: DataFrame) -> DataFrame:
    moments = stage.select(F.col("timestamp").alias("ts")).where(F.col("ts").isNotNull()).distinct()
    return moments.select(time_key(F.col("ts")).alias("time_key"), "ts", *[c.alias(n) for n, c in calendar(F.col("ts")).items()])


def dim_session(stage: DataFrame) -> DataFrame:
    ids = stage.select(session_of(stage).alias("session_id")).where(F.col("session_id") != "").distinct()
    return schemas.conform(ids.withColumn("session_key", F.col("session_id")), schemas.DIM_SESSION)


def dim_source(stage: DataFrame) -> DataFrame:
    """Latest row per dataset by ingest time (then by batch, method and version, so that ties are stable)."""
    order = ["ingest_timestamp", "batch_id", "collection_method", "version"]
    named = stage.where(F.col("dataset_name") != "")
    latest = named.groupBy("dataset_name").agg(F.max(F.struct(*order)).alias("last"))
    flat = latest.select("dataset_name", "last.*").withColumn("source_key", name_key(F.col("dataset_name")))
    return schemas.conform(flat, schemas.DIM_SOURCE)


# --- maintenance -----------------------------------------------------------------------------


def upsert(current: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Update-all on conflict: new rows replace current ones of the same key."""
    return current.join(new.select(key), key, "left_anti").unionByName(new.select(*current.columns))


def insert_if_absent(current: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return current.unionByName(new.join(current.select(key), key, "left_anti").select(*current.columns))


def same_task(left: DataFrame, right: DataFrame, right_category: str = "category") -> Column:
    """Null-safe equality on all seven attributes; Spark still hashes on them."""
    sources = zip(TASK_KEYS, _task_sources(right_category))
    return reduce(Column.__and__, [left[name].eqNullSafe(right[source]) for name, source in sources])


def new_tasks(current: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates whose description is not in the dimension yet."""
    return candidates.join(current, same_task(current, candidates), "left_anti")


# --- facts -----------------------------------------------------------------------------------


def execution_facts(stage: DataFrame) -> DataFrame:
    """Facts with keys computed in place: a projection, no shuffle and no join."""
    keyed = stage.where(F.col("prompt_hash").isNotNull()).withColumns(
        {
            "prompt_key": F.col("prompt_hash"),
            "model_key": name_key(F.col("model_name")),
            "task_key": task_key(),
            "time_key": time_key(F.col("timestamp")),
            "session_key": F.nullif(session_of(stage), F.lit("")),
            "source_key": name_key(F.col("dataset_name")),
        }
    )
    return schemas.conform(keyed, schemas.FACT_EXECUTION)


def comparison_facts(stage: DataFrame) -> DataFrame:
    """Comparison facts; a missing contestant drops the row, only model_a/model_b count as winners."""
    keyed = stage.where(F.col("prompt_hash").isNotNull()).withColumns(
        {
            "prompt_key": F.col("prompt_hash"),
            "model_a_key": name_key(F.col("model_a")),
            "model_b_key": name_key(F.col("model_b")),
            "winner_model_key": name_key(winner_model("winner", "model_a", "model_b")),
            "time_key": time_key(F.col("timestamp")),
            "source_key": name_key(F.col("dataset_name")),
        }
    ).dropna(subset=["model_a_key", "model_b_key"])
    return schemas.conform(keyed, schemas.FACT_COMPARISON)


def looked_up_execution_facts(stage: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Facts with keys taken from given dimensions, for dimensions whose keys came from elsewhere.

    Inner on the prompt, left on the rest, null-safe on the task. No broadcast hints: the optimizer broadcasts a
    dimension when its measured size allows it and otherwise merges, splitting skewed partitions.
    """
    task = dims["dim_task"].dropDuplicates(list(TASK_KEYS))
    named = [
        ("dim_model", "model_key", "model_name", "model_name"),
        ("dim_session", "session_key", "session_id", "session_id"),
        ("dim_time", "time_key", "ts", "timestamp"),
        ("dim_source", "source_key", "dataset_name", "dataset_name"),
    ]
    found = stage.join(dims["dim_prompt"].select("prompt_key", "prompt_hash"), "prompt_hash")
    for dim, key, natural, staged_name in named:
        side = dims[dim].select(key, F.col(natural).alias(f"_{natural}"))
        found = found.join(side, F.col(staged_name) == F.col(f"_{natural}"), "left").drop(f"_{natural}")
    found = found.join(task, same_task(task, found, "task_category"), "left").select(found["*"], task["task_key"])
    return schemas.conform(found, schemas.FACT_EXECUTION)


def looked_up_comparison_facts(stage: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Comparison facts with the model dimension in three roles."""
    winner = winner_model("winner", "model_a", "model_b")
    found = stage.withColumn("winner_name", winner).join(
        dims["dim_prompt"].select("prompt_key", "prompt_hash"), "prompt_hash"
    )
    for role, name, how in (
        ("model_a_key", "model_a", "inner"),
        ("model_b_key", "model_b", "inner"),
        ("winner_model_key", "winner_name", "left"),
    ):
        side = dims["dim_model"].select(F.col("model_key").alias(role), F.col("model_name").alias(name))
        found = found.join(side, name, how)
    times = dims["dim_time"].select("time_key", F.col("ts").alias("timestamp"))
    sources = dims["dim_source"].select("source_key", "dataset_name")
    found = found.join(times, "timestamp", "left").join(sources, "dataset_name", "left")
    return schemas.conform(found, schemas.FACT_COMPARISON)


def training_extract(facts: DataFrame, prompts: DataFrame, models: DataFrame, tasks: DataFrame) -> DataFrame:
    """Scored facts, left joined with prompt, model and task: the columns the models train on.

    `prompts` carries its text features (see `with_training_features`) instead of the text: they are computed once
    per prompt, and the joined rows stay narrow.
    """
    wide = (
        facts.where(F.col("success_score").isNotNull())
        .join(prompts, "prompt_key", "left")
        .join(models.select("model_key", "model_name", F.col("version").alias("model_version"), "provider"), "model_key", "left")
        .join(tasks.select("task_key", "task_type", "domain", "difficulty"), "task_key", "left")
    )
    return wide.withColumns(
        {
            "execution_status": F.when(F.col("success_score") >= 0.5, "success").otherwise("failure"),
            "tokens_used": F.col("tokens"),
            "latency_ms": F.col("latency"),
            "attempt_count": F.lit(1),
            "success_rate": F.col("success_score"),
        }
    )


def newest(facts: DataFrame, at: str, key: str, n: int = 100_000) -> DataFrame:
    """The n newest facts by the timestamp `at`, then by the unique `key`.

    Only these two columns are ordered; the wide rows are then fetched by a semi join.
    """
    known = facts.select(key, F.unix_micros(at).alias("_at")).where(F.col("_at").isNotNull())
    top = first_rows(known, -F.col("_at"), [F.desc(key)], n)
    return facts.join(top.select(key), key, "left_semi")


def random_rows(df: DataFrame, key: str, n: int = 25_000, seed: int = 42) -> DataFrame:
    """A reproducible sample of exactly n rows (all, if there are fewer); `key` is unique."""
    top = first_rows(df.select(key), hash_order(F.col(key), seed), [F.asc(key)], n, ORDER_BITS - HASH_BITS)
    return df.join(top, key, "left_semi")
