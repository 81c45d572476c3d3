import random

import public_tokenizers
from pyspark.sql import functions as F

from llm.common import docs_of, no_docs, rows_of
from turnlake.llm import token_counts as op

PATH = public_tokenizers.path("piece_bpe_32k.model")


def brute(word, vocabulary):
    """Tokens of the best division by a table over all divisions of one word."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        n = len(word[end - 1].encode())
        ways = [(best[end - 1][0] + n * vocabulary.byte, best[end - 1][1] - n)]
        ways += [(best[i][0] + vocabulary.scores[word[i:end]], best[i][1] - 1) for i in range(end) if word[i:end] in vocabulary.scores]
        best.append(max(ways))
    return -best[-1][1]


def test_equals_division_word_by_word(spark):
    pick = random.Random(10)
    texts = [None, "", "\t \x0b", "the The THE", "naïve \U0001f600 中文字 \x00", "x" * 3000]
    texts += [" ".join("".join(pick.choices("aehinorst中é", k=pick.randrange(1, 20))) for _ in range(50)) for _ in range(30)]
    texts += texts[6:9] + ["the " * 50_000]
    docs = docs_of(spark, texts).withColumn("n_tokens", F.lit("x"))
    vocabulary = op.Vocabulary(PATH)
    found = rows_of(op.token_counts(docs, PATH))
    for i, text in enumerate(texts):
        words = (text or "").encode().split()
        counts = {w: brute("▁" + w.decode(), vocabulary) for w in set(words)}
        assert (found[i]["n_pre_tokens"], found[i]["n_tokens"]) == (len(words), sum(counts[w] for w in words))


def test_shared_prefixes_are_scored_once_and_a_full_trie_is_dropped():
    trie = op.Trie(op.Vocabulary(PATH))
    trie.insert("▁there")
    size = len(trie)
    trie.insert("▁the")
    assert len(trie) == size
    trie.insert("▁therefore")
    assert len(trie) == size + 4
    small, large = op.Counter(PATH, nodes=10), op.Counter(PATH)
    for texts in ([b"some words here", b"here some"], [b"other words", b"some"], [b""]):
        assert small.counts(texts) == large.counts(texts)


def test_empty_table_and_null_ids(spark):
    assert op.token_counts(no_docs(spark), PATH).count() == 0
    docs = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert sorted(r["n_pre_tokens"] for r in op.token_counts(docs, PATH).collect()) == [0, 2]
