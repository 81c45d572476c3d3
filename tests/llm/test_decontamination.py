import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from llm.common import docs_of, no_docs, rows_of
from turnlake.llm import decontamination as op

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    words, hit, names = words_of(text), set(), set()
    for name, item in items:
        its = words_of(item)
        for i in range(max(1, len(its) - 12)) if its else ():
            window = its[i : i + 13]
            for j in range(len(words) - len(window) + 1):
                if words[j : j + len(window)] == window:
                    hit |= set(range(j, j + len(window)))
                    names.add(str(name))
    return len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)


def cases():
    pick = random.Random(6)
    letters = ["a", "b", "C", "é", "d9", "ü"]
    items = [(i, " ".join(pick.choices(letters, k=pick.choice([1, 3, 12, 13, 14, 40])))) for i in range(2, 14)]
    items += [(1, None), (20, "..."), (21, "x y z"), (21, "q r s"), (30, "b " * 20)]
    texts = [None, "", "...", "x Y-z", "q r s", "q r", "b " * 40, "no hit here " * 30 + "x y z"]
    for _ in range(40):
        parts = [" ".join(pick.choices([*letters, "other", "word"], k=pick.randrange(80)))]
        if pick.random() < 0.6:
            parts.insert(pick.randrange(2), (items[pick.randrange(12)][1] or "").upper().replace("É", "é").replace("Ü", "ü").replace(" ", ",\n"))
        texts.append(" ".join(parts))
    texts.append("long " * 40_000 + items[5][1])
    return items, [*texts, *texts[10:20]]


def test_equals_brute_force(spark):
    items, texts = cases()
    docs = docs_of(spark, texts).withColumn("spans", F.lit(1)).withColumn("n_words", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for how in ({}, {"block_bytes": 60, "shard": 300}):
        found = rows_of(op.contamination(docs, bench, **how))
        for i, text in enumerate(texts):
            row = found[i]
            assert (row["n_words"], row["n_hit"], row["n_items"], row["items_sha256"], row["contaminated"]) == brute(text, items), (how, text[:80])
            assert sum(s["end"] - s["start"] for s in row["spans"]) == row["n_hit"]
        kept = op.decontaminated(docs, bench, **how)
        assert kept.columns == docs.columns
        assert {r["doc_id"] for r in kept.collect()} == {i for i, row in found.items() if not row["contaminated"]}


def test_empty_tables_and_null_ids(spark):
    bench = spark.createDataFrame([(None, "a b"), (None, "c d")], "item_id long, text string")
    docs = spark.createDataFrame([(None, "a b c d"), (None, None)], "doc_id long, text string")
    assert sorted((r["n_hit"], r["n_items"]) for r in op.contamination(docs, bench).collect()) == [(0, 0), (4, 1)]
    assert op.contamination(no_docs(spark), bench).count() == 0
    assert [r["n_words"] for r in op.contamination(docs, bench.where("false")).collect()] == [4, 0]


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(7)
    for sigma in (2, 3, 20):
        text = np.concatenate((rng.integers(1, sigma, 3000), [0]))
        index = op.FMIndex(text, sigma)
        phrases = np.stack([text[i : i + 4] for i in range(0, 400, 7)] + [np.full(4, sigma - 1)])
        alive, low, high = index.search(phrases)
        for number, a, b in zip(alive, low, high, strict=True):
            expected = [i for i in range(len(text) - 4) if (text[i : i + 4] == phrases[number]).all()]
            assert sorted(index.locate(np.arange(a, b))) == expected
        assert set(range(len(phrases) - 1)) <= set(alive)
