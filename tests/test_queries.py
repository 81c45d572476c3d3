"""Registered queries against their SQL on the smallest data (the whole set: `python -m checks.compare`)."""

from pathlib import Path

import pytest

from checks import compare, registry

SMALL = "/root/testdata/sf0.001"
QUICK = (
    "chat_turn_pairs", "arena_events", "prompt_features", "clean_events", "stage_hygiene", "prompt_validity_report",
    "fact_prompt_execution", "daily_model_success", "feature_board", "what_if_features", "stream_daily_counts", "eda_extract",
    "train_split", "stratified_split", "random_sample", "training_extract", "training_set", "confusion_tests", "scores_with_models",
)

pytestmark = pytest.mark.skipif(not Path(SMALL).is_dir(), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SMALL)


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, connection, name):
    good, note = compare.compared(spark, connection, SMALL, name)
    assert good, note


def test_registry():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(registry.QUERIES) == len({q.__name__ for q in registry.QUERIES.values()})


def test_flagship(spark):
    import __spark_entry__ as entry

    board = entry.entry(spark)
    assert "feature_combination_id" in board.columns and board.count() > 0
