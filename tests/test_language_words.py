"""A profile counts words first and makes the trigrams of each word once."""

from collections import Counter

from pyspark.sql import functions as F

from turnlake.operators import language

WORDS = ("a", "été", "naïve", "𝒜𝒷c", "straße", "i̇x", "x" * 40)


def buckets(word):
    points = [ord(c) for c in f" {word} "]
    return [sum(p * m for p, m in zip(points[i:], language.MIX)) % language.BUCKETS for i in range(len(points) - 2)]


def test_trigrams_of_a_word_take_each_character_once(spark):
    words = spark.createDataFrame([(w,) for w in WORDS], "w string")
    rows = words.select("w", F.expr(language.word_trigrams_sql("w")).alias("found")).collect()
    assert {row["w"]: row["found"] for row in rows} == {w: buckets(w) for w in WORDS}
    assert language.word_trigrams_sql("w").count("ascii(") == 1


def test_profile_of_repeated_words_equals_counts_by_text(spark):
    texts = [(f"{a} {b} {a}", lang) for lang in ("x", "y") for a in ("été", "la", "𝒜𝒷c") for b in ("la", "où", lang)]
    found = {(r["lang"], r["bucket"]): r["weight"] for r in language.fitted(spark.createDataFrame(texts, "text string, lang string")).collect()}
    for lang in ("x", "y"):
        counts = Counter(b for text, of in texts if of == lang for word in set(text.split()) for b in buckets(word))
        assert {b for of, b in found if of == lang} == {*counts, language.UNSEEN}
        # the same order of weights as of counts
        assert len({found[lang, b] for b in counts}) == len(set(counts.values()))
