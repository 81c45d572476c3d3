import pytest
from pyspark.sql import functions as F

from turnlake.functions.text import spoken_language
from turnlake.operators import language
from turnlake.operators.features import with_prompt_features

SEEN = {
    "en": "the quick brown fox jumps over the lazy dog while they were thinking about what should happen with the other things",
    "fr": "le renard brun saute par dessus le chien paresseux pendant que nous étions dans la maison avec les autres enfants",
    "de": "der schnelle braune fuchs springt über den faulen hund während wir nicht wussten welche dinge noch geschehen würden",
    "es": "el rápido zorro marrón salta sobre el perro perezoso mientras nosotros estábamos en la casa con los otros niños",
}
CASES = [
    ("they think that the others should go", "en"),
    ("Nous étions dans la MAISON!", "fr"),
    ("wir wussten nicht, welche hunde", "de"),
    ("los niños estaban sobre la casa", "es"),
    ("これはペンです", "ja"),
    ("안녕하세요", "ko"),
    ("", "unknown"),
    (None, "unknown"),
    ("12 + 34 = 46!", "unknown"),
    ("x" * 41, "unknown"),
]


@pytest.fixture(scope="module")
def profile(spark):
    rows = [(t, c) for c, t in SEEN.items()] + [(None, "en"), ("no label", None)]
    return language.Profile.read(language.fitted(spark.createDataFrame(rows, "text string, lang string")))


def test_fixed_cases(spark, profile):
    found = spark.createDataFrame(CASES, "t string, expected string").select("expected", profile.detected("t").alias("found"))
    assert [r["found"] for r in found.collect()] == [c for _, c in CASES]


def test_weights_are_log_probabilities(spark):
    rows = [("ab ab", "xx"), ("ab", "xx")]
    table = language.fitted(spark.createDataFrame(rows, "text string, lang string"))
    found = {r["bucket"]: r["weight"] for r in table.collect()}

    def bucket(gram):
        return sum(ord(c) * f for c, f in zip(gram, language.MIX)) % language.BUCKETS

    import math

    total = 4 + 0.5 * language.BUCKETS  # "ab" once per text: two trigrams each
    assert found == {bucket(" ab"): round(1000 * math.log(2.5 / total)), bucket("ab "): round(1000 * math.log(2.5 / total)), language.UNSEEN: round(1000 * math.log(0.5 / total))}


def test_profile_labels_unlabelled_prompts_only(spark, profile):
    rows = [("wir wussten nicht, welche hunde", None), ("wir wussten nicht, welche hunde", "Mandarin")]
    df = spark.createDataFrame(rows, "prompt_text string, language string")
    assert [r["language"] for r in with_prompt_features(df, profile).select("language").collect()] == ["de", "zh"]
    assert df.select(spoken_language("prompt_text", "language").alias("x")).collect()[1]["x"] == "zh"


def test_no_labelled_texts(spark):
    empty = language.Profile.read(language.fitted(spark.createDataFrame([], "text string, lang string")))
    row = spark.createDataFrame([("hello", "日本語のテキスト かな")], "a string, b string").select(empty.detected("a").alias("a"), empty.detected("b").alias("b")).first()
    assert (row["a"], row["b"]) == ("unknown", "ja")


def test_too_many_languages(spark):
    table = spark.range(language.MOST_LANGUAGES + 1).select(F.concat(F.lit("l"), "id").alias("lang"), F.lit(language.UNSEEN).alias("bucket"), F.lit(-1).alias("weight"))
    with pytest.raises(ValueError, match="at most"):
        language.Profile.read(table)
