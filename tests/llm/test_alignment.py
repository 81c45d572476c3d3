import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from llm.common import docs_of, no_docs, rows_of
from turnlake.llm import alignment as op

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def one(both, text):
    """Tokens and groups by walking both lists together."""
    if not text:
        return [], [], []
    a, b = both.a.encode([text])[0], both.b.encode([text])[0]
    whole = f" {text}".encode()
    if b"".join(both.a.bytes[i] for i in a) != whole or b"".join(both.b.bytes[i] for i in b) != whole:
        return [], [], []
    groups, i, j, ends = [], 0, 0, [0, 0]
    while i < len(a):
        left, right = [a[i]], [b[j]]
        ends = [ends[0] + len(both.a.bytes[a[i]]), ends[1] + len(both.b.bytes[b[j]])]
        i, j = i + 1, j + 1
        while ends[0] != ends[1]:
            if ends[0] < ends[1]:
                left.append(a[i])
                ends[0], i = ends[0] + len(both.a.bytes[a[i]]), i + 1
            else:
                right.append(b[j])
                ends[1], j = ends[1] + len(both.b.bytes[b[j]]), j + 1
        groups.append((left, right))
    return a, b, groups


def brute(both, rows):
    found = [(i, *one(both, t)) for i, t in rows]
    counts = Counter((l[-1], r[-1]) for *_, groups in found for l, r in groups)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for i, a, b, groups in found:
        links = [(l[-1], r[-1]) for l, r in groups]
        text = ";".join(",".join(map(str, l)) + "|" + ",".join(map(str, r)) for l, r in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append((i, len(a), len(b), len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), digest))
    return sorted(out, key=str)


def awkward(pick, n):
    words = ["the", "word", "éclair", "naïve", "日本", "😀", "12345", "a_b", "...", "'s", "\n", "\t", "  ", "x" * 40, "<s>", "<|endoftext|>", "▁", "\r\n", "İ", "\x00", " "]
    texts = ["".join(pick.choice(words) + pick.choice([" ", "", "", "\n"]) for _ in range(pick.randrange(1, 30))) for _ in range(n)]
    return [None, "", " ", "\n", "a", "a ", " a", *texts, *texts[:5]]


def test_equals_walking_both_lists(spark):
    texts = awkward(random.Random(4), 150)
    docs = docs_of(spark, texts).withColumn("pairs", F.lit(1)).withColumn("row", F.lit("x")).repartition(3)
    want = brute(op.aligner(A, B), list(enumerate(texts)))
    for hot in (op.HOT, 7, 0):  # whatever is broadcast, the result is the same
        assert sorted((tuple(r) for r in op.link_counts(docs, A, B, hot).collect()), key=str) == want


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in op.link_counts(docs, A, B).collect()), key=str) == brute(op.aligner(A, B), rows)


def test_null_and_repeated_ids(spark):
    rows = [(None, "one two"), (None, "one two"), (3, "one"), (3, "one"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in op.link_counts(docs, A, B).collect()), key=str) == brute(op.aligner(A, B), rows)
    assert op.link_counts(no_docs(spark), A, B).count() == 0


def test_long_text_without_spaces(spark):
    texts = ["ab" * 60_000, "word " * 30_000]
    assert sorted((tuple(r) for r in op.link_counts(docs_of(spark, texts), A, B).collect()), key=str) == brute(op.aligner(A, B), list(enumerate(texts)))


@pytest.mark.parametrize("size", [0, 1, 2, 31, 32, 33, 500])
def test_gallop_equals_set_intersection(size):
    rng = np.random.default_rng(size)
    for spread in (1, 3, 50):
        a, b = (np.unique(rng.integers(0, spread * size + 1, n)) for n in (size, 4 * size))
        at_a, at_b = op.intersect(a, b)
        want = np.intersect1d(a, b)
        assert (a[at_a] == want).all() and (b[at_b] == want).all() and len(at_a) == len(want)


def test_spans_of_one_text(spark):
    row = rows_of(op.alignments(docs_of(spark, ["naïve words", None]), A, B))
    both, groups = op.aligner(A, B), row[0]["groups"]
    whole = " naïve words".encode()
    assert b"".join(both.a.bytes[i] for i in row[0]["a"]) == whole and groups[-1]["end"] == len(whole)
    for token, range_ in zip(range(len(row[0]["a"])), row[0]["overlap"], strict=True):
        begin, end = ([0, *row[0]["a_ends"]][token], row[0]["a_ends"][token])
        b_ends = row[0]["b_ends"]
        sharing = [j for j in range(len(b_ends)) if b_ends[j] > begin and ([0, *b_ends][j]) < end]
        assert [range_["first_b"], range_["last_b"]] == [sharing[0], sharing[-1]]
    assert row[1]["a"] == [] and row[1]["groups"] == []


def test_both_encoders_agree():
    pick, tokens = random.Random(8), op.aligner(A, B).a
    assert tokens.ranks is not None
    texts = ["".join(chr(pick.choice([pick.randrange(256), pick.randrange(32, 127), 32, 10, 39])) for _ in range(pick.randrange(30))) for _ in range(20_000)]
    texts += ["<|endoftext|>", "a<|endoftext|>b", "x" * 30_000]
    assert tokens.encode(texts) == [found.ids for found in tokens.tokenizer.encode_batch([f" {t}" for t in texts], add_special_tokens=False)]
