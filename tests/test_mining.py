import random
from collections import Counter
from itertools import combinations

import pytest
from conftest import values

from turnlake.operators import mining


def baskets(spark, seed=6, n=300):
    rng = random.Random(seed)
    rows = [sorted(i for i in "abcdef" if rng.random() < (0.3 + 0.1 * "abcdef".index(i))) for _ in range(n)]
    return rows, spark.createDataFrame([(r,) for r in rows if r], "items array<string>")


def brute_sets(rows, support):
    rows = [r for r in rows if r]
    counts = Counter(s for r in rows for k in range(1, len(r) + 1) for s in combinations(r, k))
    return {s: c / len(rows) for s, c in counts.items() if c / len(rows) >= support}


def test_itemsets_equal_all_subsets(spark):
    rows, df = baskets(spark)
    got = {tuple(r["items"]): r["support"] for r in mining.frequent_itemsets(df, 0.08).collect()}
    expected = brute_sets(rows, 0.08)
    assert got.keys() == expected.keys() and all(abs(got[s] - expected[s]) < 1e-12 for s in got)
    short = mining.frequent_itemsets(df, 0.08, longest=2)
    assert {tuple(r["items"]) for r in short.collect()} == {s for s in expected if len(s) <= 2}


def test_rules_have_every_split(spark):
    rows, df = baskets(spark)
    sets = brute_sets(rows, 0.08)
    expected = {}
    for s in sets:
        for k in range(1, len(s)):
            for left in combinations(s, k):
                right = tuple(i for i in s if i not in left)
                confidence = sets[s] / sets[left]
                if confidence >= 0.5 and confidence / sets[right] >= 1.05:
                    expected[left, right] = (confidence, confidence / sets[right])
    rules = mining.association_rules(mining.frequent_itemsets(df), min_lift=1.05)
    got = {(tuple(r["antecedents"]), tuple(r["consequents"])): (r["confidence"], r["lift"]) for r in rules.collect()}
    assert got.keys() == expected.keys() and any(len(right) > 1 for _, right in got)
    assert all(abs(a - b) < 1e-9 for k in got for a, b in zip(got[k], expected[k]))
    top = mining.top_rules(rules, 3).collect()
    assert [r["lift"] for r in top] == sorted((v[1] for v in expected.values()), reverse=True)[:3]


def test_two_item_consequent_and_conviction(spark):
    df = spark.createDataFrame([(["a", "b", "c"],)] * 2 + [(["d"],)] * 2, "items array<string>")
    rules = mining.association_rules(mining.frequent_itemsets(df))
    found = {(tuple(r["antecedents"]), tuple(r["consequents"])): r for r in rules.collect()}
    rule = found[("a",), ("b", "c")]
    assert (rule["confidence"], rule["lift"], rule["leverage"], rule["conviction"]) == (1.0, 2.0, 0.25, None)
    stats = {r["scope"]: r["rules"] for r in mining.rule_stats(rules, 5).collect()}
    assert stats == {"all": 12, "top": 5}
    assert {r["avg_confidence"] for r in mining.rule_lookup(rules, 4).collect()} == {1.0}


def test_lower_confidence_when_none_reaches_the_first(spark):
    df = spark.createDataFrame([(["a", "b"],)] * 2 + [(["a"],)] * 3 + [(["b"],)] * 3 + [(["z"],)] * 8, "items array<string>")
    sets = mining.frequent_itemsets(df)
    assert mining.association_rules(sets, min_lift=1.0).count() == 2  # 0.4 confidence, above the fallback of 0.3


def test_transactions(spark):
    rows = [(True, False, 10, 0.1, "en", 1.0), (False, True, 20, 0.2, "fr", 0.0), (False, False, 30, 0.3, "en", 0.5), (False, False, 40, 0.3, "en", 0.6)]
    df = spark.createDataFrame(rows, "contains_code boolean, contains_examples boolean, prompt_length int, instruction_density double, language string, success_rate double")
    got = [r["items"] for r in mining.transactions(df, ("language",)).collect()]
    assert got == [
        ["contains_code=1", "language_en=1", "success_high"],
        ["contains_examples=1", "language_fr=1"],
        ["instruction_density_high", "language_en=1"],
        ["instruction_density_high", "language_en=1", "prompt_length_high", "success_high"],
    ]
    assert mining.transactions(df.select("prompt_length", "success_rate")).count() == 2


def test_categorical_rules(spark):
    df = spark.createDataFrame([(True, "Success")] * 6 + [(False, "Failure")] * 3 + [(True, "Failure")], "code boolean, outcome string")
    rules = {(tuple(r["antecedents"]), tuple(r["consequents"])): r["confidence"] for r in mining.categorical_rules(df, ["code", "outcome"]).collect()}
    assert rules[(), ("code=true",)] == pytest.approx(0.7) and rules[(), ("outcome=Success",)] == pytest.approx(0.6)
    assert rules[("code=true",), ("outcome=Success",)] == pytest.approx(6 / 7) and rules[("code=false",), ("outcome=Failure",)] == 1.0
    assert all(len(right) == 1 for _, right in rules) and values(mining.categorical_rules(df, ["code"], longest=1).select("consequents")) != []


def test_wide_baskets_keep_every_rule(spark):
    """One set of 18 items with a 17-item and a one-item subset; 33 items in a basket run as well."""
    names = [f"i{i:02}" for i in range(18)]
    rows = [(tuple(names), 0.5), (tuple(names[:17]), 0.5), ((names[17],), 0.5)]
    itemsets = spark.createDataFrame(rows, "items array<string>, support double")
    found = {(tuple(r["antecedents"]), tuple(r["consequents"])) for r in mining.all_rules(itemsets).collect()}
    assert found == {(tuple(names[:17]), (names[17],)), ((names[17],), tuple(names[:17]))}
    wide = spark.createDataFrame([([f"x{i}" for i in range(33)],)] + [([f"x{i}", "y"],) for i in range(33)], "items array<string>")
    assert {tuple(r["items"]) for r in mining.frequent_itemsets(wide, 0.5).collect()} == {("y",)}


def test_wide_equal_baskets_stop_at_the_longest(spark):
    """30 items in each of 50 baskets have a billion frequent sets; up to three items there are 4,525."""
    df = spark.createDataFrame([([f"x{i:02}" for i in range(30)],)] * 50, "items array<string>")
    sets = mining.frequent_itemsets(df, 0.5, longest=3).collect()
    assert Counter(len(r["items"]) for r in sets) == {1: 30, 2: 435, 3: 4060} and {r["freq"] for r in sets} == {50}


def test_repeated_items_and_no_baskets(spark):
    df = spark.createDataFrame([(["a", "a", "b"],), (["b"],), ([],)], "items array<string>")
    assert {tuple(r["items"]): r["freq"] for r in mining.frequent_itemsets(df, 0.3).collect()} == {("a",): 1, ("b",): 2, ("a", "b"): 1}
    none = mining.frequent_itemsets(df.where("false"))
    assert none.count() == 0 and mining.all_rules(none).count() == 0
