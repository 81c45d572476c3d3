from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.common import DOCS, no_docs
from turnlake.llm import mixing as op
from turnlake.session import stored


def brute_targets(sizes, weights=(1, 2, 3)):
    """Shares by weight; what a full source can't take is shared again until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in full else share[s] for s in order}
        full |= over


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 60))), "en", s, 0) for i, s in enumerate(["a"] * 300 + ["b"] * 30 + ["é"] * 5 + [None] * 60 + ["c"] * 2)]
    rows += [(1000, None, "en", "a", 0), (1001, "", "en", "b", 0), (None, "x y", "en", "a", 0), (7, "twice here", "en", "a", 0), (1002, "long " * 30_000, "en", "hot", 0)]
    return spark.createDataFrame(rows, DOCS).withColumn("block", F.lit("x"))


def test_targets(spark, docs):
    made = op.plan(docs)
    rows = op.taken(made).join(docs.select("doc_id", "source").distinct(), "doc_id").collect()
    sizes = {r["source"]: r["source_size"] for r in rows}
    expected = brute_targets(sizes)
    for r in rows:
        assert r["target"] == pytest.approx(expected[r["source"]])
        assert r["taken"] in {n * r["size"] for n in range(4)}
    assert sum({r["source"]: r["target"] for r in rows}.values()) == pytest.approx(sum(sizes.values()))


def test_taken_comes_near_the_targets_and_reruns_agree(spark, docs):
    small = docs.where("source <> 'hot' and doc_id is not null and doc_id <> 7")
    rows = op.taken(op.plan(small)).join(small.select("doc_id", "source"), "doc_id").collect()
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for r in rows:
        assert abs(taken[r["source"]] - r["target"]) <= 2 * largest[r["source"]]
    again = op.taken(op.plan(small.repartition(7))).collect()
    assert {(r["doc_id"], r["taken"]) for r in rows} == {(r["doc_id"], r["taken"]) for r in again}


def test_shards_take_equal_numbers_of_disjoint_draws(spark, docs):
    made = op.plan(docs, shard_words=2000)
    draws = made.draws.collect()
    assert made.shards > 16 and len({(d["source_no"], d["block"], d["copy"]) for d in draws}) == len(draws)
    per_shard = defaultdict(int)
    for d in draws:
        per_shard[d["shard"]] += 1
    assert max(per_shard.values()) - min(per_shard.values()) <= 1 and set(per_shard) == set(range(made.shards))


def test_mixed_documents(spark, docs):
    one_each = stored(docs.dropDuplicates(["doc_id"]), "docs")
    made = op.plan(one_each)
    out = op.mixed(one_each, made)
    assert out.columns == docs.columns
    counts = {(r["doc_id"], r["source"]): r["count"] for r in out.groupBy("doc_id", "source").count().collect()}
    for r in op.taken(made).join(one_each.select("doc_id", "source"), "doc_id").where("size > 0").collect():
        assert r["taken"] == r["size"] * counts.get((r["doc_id"], r["source"]), 0)


def test_split_is_exact_and_unbiased():
    quotas, capacities = np.array([50, 0, 10, 940]), np.array([300, 300, 400])
    made = [op._split(node, quotas, capacities, 1) for node in range(400)]
    for rows in made:
        assert (rows.sum(axis=0) == quotas).all() and (rows.sum(axis=1) == capacities).all() and (rows >= 0).all()
    assert np.mean([rows[0] for rows in made], axis=0) == pytest.approx(quotas * 0.3, rel=0.05, abs=0.2)


def test_empty_table_and_no_words(spark):
    assert op.taken(op.plan(no_docs(spark))).count() == 0
    blank = spark.createDataFrame([(1, None, "en", None, 0), (2, " ", "en", "a", 0)], DOCS)
    assert {(r["size"], r["target"], r["taken"]) for r in op.taken(op.plan(blank)).collect()} == {(0, 0.0, 0)}
    assert op.mixed(blank, op.plan(blank)).count() == 0


def test_a_third_of_the_rows_without_an_id(spark):
    """Every source comes within 2 % of its target or one largest document, equal and nameless rows included."""
    rng = np.random.default_rng(3)
    rows = [(None, " ".join(["w"] * int(rng.integers(1, 30))), "en", "a", 0) for _ in range(300)] + [(None, "one and the same", "en", "a", 0)] * 200
    rows += [(i, " ".join(["w"] * int(rng.integers(1, 30))), "en", "b", 0) for i in range(400)] + [(5, "again", "en", None, 0)] * 300
    docs = stored(spark.createDataFrame(rows, DOCS).repartition(5), "docs")
    for part in (docs, docs.where("text <> 'again'")):
        made = op.plan(part)
        found = made.documents.join(made.draws, ["source_no", "block"], "left").groupBy("source").agg(
            F.first("target").alias("target"), F.sum(F.when(F.col("copy").isNotNull(), F.col("size"))).alias("taken"), F.max("size").alias("largest")
        )
        for r in found.collect():
            assert abs(r["taken"] - r["target"]) <= max(0.02 * r["target"], r["largest"])
        assert max(r["taken"] / max(1, r["size"]) for r in op.taken(made).collect()) <= 3
        assert op.taken(made).count() == part.count()
    made = op.plan(docs)
    out = Counter((r["doc_id"], r["text"]) for r in op.mixed(docs, made).collect())
    sizes = op.taken(made).groupBy("doc_id").agg(F.sum("taken").alias("taken")).collect()
    assert {r["doc_id"]: r["taken"] for r in sizes if r["taken"]} == {
        i: sum(n * len(t.split()) for (j, t), n in out.items() if j == i) for i in {i for i, _ in out}
    }
