import pytest
from pyspark.sql import functions as F

from checks import registry
from turnlake.functions import text

SMALL = "/root/testdata/sf0.001"


class Seen(Exception):
    pass


@pytest.mark.parametrize(("query", "fit"), [("cluster_assignment", "fit_clusters"), ("model_scores", "fit_forest")])
def test_models_are_fitted_on_stored_features(spark, monkeypatch, query, fit):
    def caught(df, *_):
        raise Seen(df.inputFiles())

    monkeypatch.setattr(registry.models, fit, caught)
    with pytest.raises(Seen) as seen:
        registry.QUERIES[query](spark, SMALL)
    [files] = seen.value.args
    assert files and not any("testdata" in file for file in files)


def test_the_extract_makes_no_unread_features(spark):
    made = registry._extract(spark, SMALL).columns
    assert {"prompt_word_count", "language", "latency_ms", "prompt_length"} <= set(made)
    assert not {"programming_lang", "prompt_hash", "constraint_count", "example_count", "complexity_score"} & set(made)


def test_blanks_beside_single_spaces(spark):
    texts = ["a b", "a  b", " a ", "a \tb", "a\t b", "a \x1fb", "a\x1f b", "a \x1f\u3000 b", "\xa0a b\xa0", " ", "", None, "a b c  d e"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.normalize(F.col("t")).alias("n"))
    plain = {t: " ".join((t or "").split()) for t in texts}
    assert {row["t"]: row["n"] for row in rows.collect()} == plain
    words = rows.select("t", text.word_count(F.col("n")).alias("w"))
    assert {row["t"]: row["w"] for row in words.collect()} == {t: len(n.split()) for t, n in plain.items()}


def test_stop_words_are_filtered_once(spark):
    """The words of a text are split and looked through one time; the languages then see known words only."""
    plan = spark.createDataFrame([("the of",)], "t string").select(text.detected_language("t").alias("d"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(lower") == 1 and plan.count("filter(") == len(text.STOP_WORDS) + 1
    said = ["the of le", "le la the", "nothing here", "der die das", "que", "", None, "el que para", "IST NICHT"]
    found = spark.createDataFrame([(t,) for t in said], "t string").select(text.detected_language("t")).collect()
    assert [row[0] for row in found] == ["en", "fr", "unknown", "de", "es", "unknown", "unknown", "es", "de"]
