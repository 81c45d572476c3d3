import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from llm.common import docs_of, no_docs, rows_of
from turnlake.llm import simhash as op
from turnlake.llm.components import components


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def brute_components(prints):
    """{fingerprint: component} over all pairs."""
    label = {p: p for p in prints}
    change = True
    while change:
        change = False
        for p in label:
            for q in label:
                if (p ^ q).bit_count() <= 2 and label[p] != label[q]:
                    label[p] = label[q] = min(label[p], label[q])
                    change = True
    return label


def test_equals_brute_force(spark):
    pick = random.Random(2)
    base = [" ".join(pick.choices("alpha Beta gamma delta É ü x y z".split(), k=300)) for _ in range(6)]
    texts = [None, "", " \t", "one", "One two", "a b c", "a\x0bb\x0cc", "a b c"]
    for t in base:
        for _ in range(6):
            words = t.split(" ")
            words[pick.randrange(300)] = "changed"
            texts += [t, " ".join(words)]
    texts.append("long " * 60_000 + base[0])
    docs = docs_of(spark, texts).withColumn("fp", F.lit("x")).withColumn("component_id", F.lit(1))
    found = rows_of(op.near_duplicates(docs))
    prints = [brute_fingerprint(t) for t in texts]
    label = brute_components(set(prints))
    for i, p in enumerate(prints):
        assert found[i]["fingerprint"] == f"{p:016x}"
        assert found[i]["component_id"] == min(j for j, q in enumerate(prints) if label[q] == label[p])


def test_links_span_all_pairs_at_any_leaf_size(spark):
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(100)}
    for centre in list(prints)[:2]:
        for _ in range(150):
            flips = rng.sample(range(64), rng.randrange(1, 4))
            prints.add(centre ^ sum(1 << b for b in flips))
    prints.add(0)
    prints.add((1 << 64) - 1)
    expected = brute_components(prints)
    table = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    for leaf in (60, 100_000):
        found = {r["node"]: r["root"] for r in components(op.links(table, leaf=leaf)).collect()}
        of = {p: found.get(s := int(np.uint64(p).view(np.int64)), s) for p in prints}
        assert len(set(expected.values())) == len(set(of.values()))
        assert len({(expected[p], of[p]) for p in prints}) == len(set(of.values()))
        sizes = op.leaves(table, leaf).groupBy("path", "key").count().agg(F.max("count")).first()[0]
        assert sizes <= max(leaf, 1024)


def test_leaf_index_equals_all_pairs():
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    prints = {centre ^ sum(1 << b for b in rng.sample(range(24), rng.randrange(0, 6))) for _ in range(1500)}
    expected = brute_components(set(list(prints)[:600]))

    def rank(x):
        for s in (1, 2, 4, 8, 16, 32):
            x ^= x >> s
        return x

    order = sorted(expected, key=rank)
    a, b = op.leaf_links(np.array(order, np.uint64))
    label = list(range(len(order)))
    for i, j in zip(a, b, strict=True):
        label[i] = j
    assert len(set(label)) == len(set(expected.values()))


def test_null_ids_empty_table_and_one_of_each(spark):
    docs = spark.createDataFrame([(None, "a b c d", "k"), (2, "a b c d", "k"), (2, "a b c d", "k"), (None, "z y x w v", "k")], "doc_id long, text string, stays string")
    found = {(r["doc_id"], r["component_id"]) for r in op.near_duplicates(docs).collect()}
    assert found == {(None, 2), (2, 2), (None, None)}
    kept = op.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "None"]
    assert op.near_duplicates(no_docs(spark)).count() == 0


def test_one_of_each_keeps_texts_that_share_an_id_or_have_none(spark):
    old, other = "m n o p q r", "the quick brown fox jumps over"
    rows = [(None, "a b c d"), (None, "z y x w v"), (None, "z y x w v"), (None, "e f g h i"), (3, old), (None, old), (5, old), (5, other), (7, ""), (8, None), (9, "k l k l j"), (9, "t u t s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_digest", F.lit(1)).repartition(3)
    assert len({brute_fingerprint(t) for _, t in rows}) == len(set(brute_components({brute_fingerprint(t) for _, t in rows}).values())) == 8
    kept = op.one_of_each(docs)
    assert kept.columns == docs.columns
    expected = [(None, "a b c d"), (None, "z y x w v"), (None, "e f g h i"), (3, old), (5, other), (7, ""), (9, "k l k l j"), (9, "t u t s")]
    assert sorted(map(str, [(r["doc_id"], r["text"]) for r in kept.collect()])) == sorted(map(str, expected))
