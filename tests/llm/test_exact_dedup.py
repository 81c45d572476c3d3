import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.common import docs_of, no_docs
from turnlake.llm import exact_dedup as op


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    pick = random.Random(1)
    texts = [pick.choice(["", None, "a", "b", " b", "é" * 5000, f"t{pick.randrange(60)}"]) for _ in range(400)]
    docs = docs_of(spark, texts).withColumn("keep_id", F.lit(7)).withColumn("digest", F.lit("x"))
    found = sorted((tuple(r) for r in op.deduplicated(docs).collect()), key=str)
    assert found == brute(list(enumerate(texts)))


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "x"), (None, "x"), (3, "y"), (3, "y"), (None, "y"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((tuple(r) for r in op.deduplicated(docs).collect()), key=str)
    assert found == brute(rows)


def test_empty_table(spark):
    assert op.deduplicated(no_docs(spark)).count() == 0


def test_filter_holds_every_key_and_few_others():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 3, 10, 1000, 70_000):
        keys = rng.integers(0, 2**63, n).astype(np.uint64)
        held = op.build_filter(keys)
        assert held.contains(keys).all()
        others = rng.integers(0, 2**63, 20_000).astype(np.uint64)
        assert held.contains(others[~np.isin(others, keys)]).mean() < 0.01
    assert len(held.slots) < 1.25 * 70_000


def test_later_batches_leave_snapshots_alone(spark):
    first, second = docs_of(spark, ["a", "b", "a"]), docs_of(spark, ["b", "c", "c"], start=10)
    new, known = op.absorb(op.digests(first), [], "t")
    snapshot = op.take_snapshot(new)
    assert known is None and snapshot.groups.count() == 2
    new, known = op.absorb(op.digests(second), [snapshot], "t")
    assert [r["keep_id"] for r in known.collect()] == [10] and [r["keep_id"] for r in new.collect()] == [12]
    passed = {r[0] for r in op.screened(op.grouped(op.digests(second)), snapshot, 2).collect()}
    assert passed >= {r[0] for r in known.select("digest").collect()}


def test_a_filter_that_misses_texts_is_an_error(spark, monkeypatch):
    docs, asked = docs_of(spark, ["a", "b", "c", "d"] * 6), op.screened
    monkeypatch.setattr(op, "screened", lambda groups, snapshot, size: asked(groups, snapshot, size).where("digest % 2 = 0"))
    with pytest.raises(Exception, match="not in one snapshot but in [23]: text"):
        op.deduplicated(docs).collect()


def test_texts_of_equal_digests_are_told_apart(spark, monkeypatch):
    """Forged digests: the bytes decide, however many texts share a digest."""
    pick, made = random.Random(6), op.digests

    def forged(docs, *more):
        low = F.when(F.length("text") > 2, F.lit(7)).otherwise(F.col("digest"))
        kept = dict.fromkeys([*more, "text"])
        found = made(docs.withColumn("text", F.coalesce("text", F.lit(""))), *kept).withColumn("digest", low)
        alike = F.col("digest") == 7
        found = found.withColumns({"text_sha256": F.when(alike, "00").otherwise(F.col("text_sha256")), "n_bytes": F.when(alike, 9).otherwise(F.col("n_bytes"))})
        return found if "text" in more else found.drop("text")

    texts = [pick.choice(["aaa", "bbbb", "cccc", "ddddd", "x", "", None]) for _ in range(200)] + ["once only"]
    monkeypatch.setattr(op, "digests", forged)
    found = sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in op.deduplicated(docs_of(spark, texts)).collect())
    assert found == sorted(tuple(r[:4]) for r in brute(list(enumerate(texts))))
