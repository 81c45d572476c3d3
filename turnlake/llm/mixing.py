"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is dealt into blocks of whole documents (by a hash of id and text), at most `BLOCKS` of them, in a permuted
order. A source's quota is the exact number of block draws whose words come nearest its target: whole rounds over all
its blocks, then a prefix of the permuted order. Output shards take equal numbers of draws. The tree splits the quotas
of a node among its children by multivariate-hypergeometric draws, level by level, so every shard gets a random share of
every source and the shares add up exactly. A shard then draws its own, disjoint run of each source's permuted draws and
shuffles the documents inside itself.

The tree's nodes and the block table are small (shards x sources, at most `BLOCKS` rows a source). What runs along a source
(permuted blocks, draws, runs of draws) is laid out over range partitions and scanned, so a hot source is no hot task;
documents are only joined with their block's draws, so no text is shuffled before the mix itself.

All randomness comes from hashes of `seed`, so reruns agree. Null texts have no words; they and other texts without
words are dealt like any document and take no words. The null source is a source of its own and comes last. Rows that are
equal in id, text and source are numbered (by an ordered scan, however many there are) and dealt one by one like others. An
empty table gives an empty mix. Only `doc_id`, `text` and `source` are read; `mixed` finds rows again by their number, so the
table must give its rows in the same order when read again, as files do.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from turnlake.llm.words import fresh
from turnlake.operators.scan import laid, running_within
from turnlake.session import stored

BLOCKS = 65_536  # blocks of a source at most
REPEATS = 3  # no source, so no document, is taken more often
SHARD_WORDS = 8_000_000
FAN = 16  # children of a tree node
SPACES = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Plan:
    """`documents`: one row per input row (`row, doc_id, source, size, source_size, target, block`); `draws`: one row per draw of
    a block (`source_no, block, copy, shard`); `shards`: their number."""

    documents: DataFrame
    draws: DataFrame
    shards: int


def word_count(text: Column) -> Column:
    r"""Number of [^\x20\x09-\x0D]+; a null text has none."""
    parts = F.split(text, SPACES)
    edges = F.element_at(parts, 1).eqNullSafe("").cast("int") + ((F.size(parts) > 1) & F.element_at(parts, -1).eqNullSafe("")).cast("int")
    return F.coalesce(F.size(parts) - edges, F.lit(0)).cast("long")


def _order(*columns: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), repeats: int = REPEATS) -> DataFrame:
    """`sizes(source, source_size, ...)` with `source_no, target`.

    Sources by code point, null last, take the weights in turn. A source stops at `repeats` times its size; what it
    can't take is shared again by weight. With sources sorted by size per weight this is one running sum: all sources
    below the level are full, the others get level x weight. The windows run over one row per source.
    """
    share = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod("source_no", F.lit(len(weights))) + 1).cast("int"))
    everything, fill = W.orderBy(F.col("source").asc_nulls_last()), W.orderBy("full_at", "source_no")
    rows = sizes.withColumn("source_no", F.row_number().over(everything).cast("long") - 1).withColumn("weight", share)
    rows = rows.withColumn("most", F.lit(float(repeats)) * F.col("source_size")).withColumn("full_at", F.col("most") / F.col("weight"))
    below = fill.rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("used", F.coalesce(F.sum("most").over(below), F.lit(0.0))).withColumn("from_here", F.sum("weight").over(fill.rowsBetween(0, W.unboundedFollowing)))
    rows = rows.withColumn("all", F.sum("source_size").over(fill.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).cast("double"))
    rows = rows.withColumn("level", (F.col("all") - F.col("used")) / F.col("from_here"))
    level = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "source_no", "level"))).over(fill.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))["level"]
    rows = rows.withColumn("water", level)
    target = F.when(F.col("water").isNull() | (F.col("full_at") <= F.col("water")), F.col("most")).otherwise(F.col("water") * F.col("weight"))
    return rows.select(*sizes.columns, "source_no", target.alias("target"))


def _split(node: int, quotas: np.ndarray, capacities: np.ndarray, seed: int) -> np.ndarray:
    """How many of each source's draws go to each child: rows are children, sums are exact."""
    rng = np.random.default_rng([seed, node])
    left, out = quotas.astype(np.int64).copy(), []
    for capacity in capacities[:-1]:
        drawn, want, rest = np.zeros(len(left), np.int64), int(capacity), int(left.sum())
        for i, held in enumerate(left.tolist()):  # one marginal draw after the other
            rest -= held
            drawn[i] = rng.hypergeometric(held, rest, want) if want and held + rest else 0
            want -= int(drawn[i])
        out.append(drawn)
        left = left - drawn
    return np.stack([*out, left])


def _capacity(total: int, shards: int, first: int, last: int) -> int:
    """Draws of shards first..last-1, when `total` draws are dealt evenly."""
    return total * min(last, shards) // shards - total * min(first, shards) // shards


def _splitter(width: int, total: int, shards: int, seed: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Splits a node of `width` shards among its children."""
    below = width // FAN

    def split(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("source_no")
        node = int(rows["node"].iloc[0])
        cuts = [node * width + i * below for i in range(FAN + 1)]
        capacities = np.array([_capacity(total, shards, a, b) for a, b in zip(cuts, cuts[1:], strict=False)])
        made = _split(node * 64 + int(np.log2(width)), rows["quota"].to_numpy(), capacities, seed)
        child, source = np.nonzero(made)
        return pd.DataFrame({"node": node * FAN + child, "source_no": rows["source_no"].to_numpy()[source], "quota": made[child, source]})

    return split


def splitting_tree(quotas: DataFrame, total: int, shards: int, seed: int) -> DataFrame:
    """`quotas(source_no, quota)` split to `shard, source_no, quota`; nodes of a level are split in parallel tasks."""
    width = 1
    while width < shards:
        width *= FAN
    level = quotas.select(F.lit(0).cast("long").alias("node"), "source_no", "quota")
    while width > 1:
        level = level.groupBy("node").applyInPandas(_splitter(width, total, shards, seed), "node long, source_no long, quota long")
        width //= FAN
    return level.select(F.col("node").alias("shard"), "source_no", "quota")


def _numbered(docs: DataFrame) -> DataFrame:
    """`row, doc_id, source, size, digest, twin`: `twin` numbers the rows that are equal in id, text and source."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("digest"),
    ).withColumn("same", F.xxhash64("source", "doc_id", "digest"))
    rows = laid(stored(rows, "mix-words").withColumn("one", F.lit(1)), ["same", "row"], "mix-rows")  # texts are read once
    return running_within(rows, "same", ["one"]).select("row", "doc_id", "source", "size", "digest", F.col("running_one").alias("twin"))


def plan(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), seed: int = 42, shard_words: int = SHARD_WORDS) -> Plan:
    rows = stored(_numbered(docs), "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    sources = stored(targets(sizes, weights), "mix-sources")
    slots = F.least(F.lit(BLOCKS), F.col("n_docs") * 4)
    documents = rows.withColumnRenamed("source", "name").join(sources, F.col("name").eqNullSafe(F.col("source")))
    documents = documents.withColumn("block", F.pmod(_order("doc_id", "digest", "twin", seed=seed), slots)).select(
        "row", "doc_id", "digest", "twin", "source", "source_no", "size", "source_size", "target", "block"
    )
    blocks = documents.groupBy("source_no", "block").agg(
        F.sum("size").alias("words"), F.first("source_size").alias("source_size"), F.first("target").alias("target")
    )
    order = ["source_no", _order("source_no", "block", seed=seed + 1), "block"]  # a permutation of each source's blocks
    blocks = running_within(laid(blocks.withColumn("one", F.lit(1)), order, "mix-permuted"), "source_no", ["one", "words"])
    blocks = blocks.withColumnsRenamed({"running_words": "upto"}).withColumn("place", F.col("running_one").cast("long") - 1)
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    blocks = blocks.withColumn("rounds", rounds).withColumn("rest", F.col("target") - F.col("rounds") * F.col("source_size"))
    # A block belongs to the prefix when taking it too comes nearer the rest of the target than stopping before it.
    nearer = F.col("upto") - F.col("words") / 2 <= F.col("rest")
    blocks = blocks.withColumn("more", ((F.col("rest") > 0) & nearer & (F.col("words") > 0)).cast("long"))
    blocks = stored(blocks.select("source_no", "block", "place", "words", "rounds", "more"), "mix-blocks")
    quotas = blocks.groupBy("source_no").agg(F.sum(F.col("rounds") + F.col("more")).alias("quota")).where("quota > 0")
    total, words = blocks.agg(F.sum(F.col("rounds") + F.col("more")), F.sum((F.col("rounds") + F.col("more")) * F.col("words"))).first()
    shards = max(1, -(-int(words or 0) // shard_words))
    shares = splitting_tree(quotas, int(total or 0), shards, seed) if total else quotas.select(F.lit(0).cast("long").alias("shard"), "source_no", "quota")
    # A source's draws are in the order of round and place; the prefix comes last and has no gaps but for blocks without
    # words, which take no draw.
    draws = blocks.where("rounds + more > 0").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rounds") + F.col("more") - 1)))
    draws = laid(draws.select("source_no", "copy", "place", "block", F.lit(1).alias("one")), ["source_no", "copy", "place"], "mix-rounds")
    draws = running_within(draws, "source_no", ["one"]).withColumn("draw", F.col("running_one").cast("long") - 1)
    draws = _within(draws.select("source_no", "block", "copy", "draw"), shares)
    return Plan(documents, stored(draws, "mix-draws"), shards)


def _within(draws: DataFrame, shares: DataFrame) -> DataFrame:
    """`source_no, block, copy, shard` of draws: a source's shards take runs of its draws one after another (`shares`).

    The beginnings of runs are laid among the draws; how many a draw has before it is the number of its run.
    """
    runs = laid(shares.withColumn("one", F.lit(1)), ["source_no", "shard"], "mix-runs")
    runs = running_within(runs, "source_no", ["one", "quota"])
    runs = stored(runs.select("source_no", "shard", (F.col("running_quota") - F.col("quota")).alias("at"), F.col("running_one").alias("run")), "mix-begun")
    none = F.lit(None).cast("long")
    marks = runs.select("source_no", "at", F.lit(1).alias("mark"), none.alias("block"), none.alias("copy"))
    points = draws.select("source_no", F.col("draw").alias("at"), F.lit(0).alias("mark"), "block", "copy")
    line = laid(marks.unionByName(points), ["source_no", "at", F.desc("mark")], "mix-line")
    found = running_within(line, "source_no", ["mark"]).where("mark = 0").withColumn("run", F.col("running_mark"))
    return found.select("source_no", "block", "copy", "run").join(runs.select("source_no", "run", "shard"), ["source_no", "run"]).select("source_no", "block", "copy", "shard")


def taken(plan: Plan) -> DataFrame:
    """`doc_id, size, source_size, target, taken` and the shards a document went to, for every input row."""
    by_block = plan.draws.groupBy("source_no", "block").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("shard")).alias("shards"))
    return plan.documents.join(by_block, ["source_no", "block"], "left").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.coalesce("n", F.lit(0))).alias("taken"), F.coalesce("shards", F.array().cast("array<long>")).alias("shards")
    )


def mixed(docs: DataFrame, plan: Plan, seed: int = 42) -> DataFrame:
    """The documents of the mix, repeats included, shard after shard and shuffled inside each shard.

    Shards are ranges of the output's partitions; the columns are those of `docs`.
    """
    row, named, shard, order = (fresh(docs, f"mix_{c}") for c in ("row", "id", "shard", "order"))
    places = plan.documents.join(plan.draws, ["source_no", "block"]).select(
        F.col("row").alias(row), F.col("doc_id").alias(named), F.col("shard").alias(shard),
        _order("shard", "doc_id", "digest", "twin", "copy", seed=seed + 2).alias(order),
    )
    drawn = docs.withColumn(row, F.monotonically_increasing_id()).join(places, row)
    moved = F.raise_error(F.lit("the table gave its rows in another order than when the mix was planned")).cast("bigint")
    drawn = drawn.withColumn(shard, F.when(F.col("doc_id").eqNullSafe(F.col(named)), F.col(shard)).otherwise(moved))
    return drawn.repartitionByRange(plan.shards, shard, order).sortWithinPartitions(shard, order).select(*docs.columns)
