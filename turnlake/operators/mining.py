"""Transactions, frequent itemsets and association rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnlake.operators.ordered import exact_quantiles
from turnlake.session import stored, stored_observed

FLAG_ITEMS = ("contains_code", "contains_examples", "contains_constraints")
ABOVE_UPPER_QUARTILE = ("prompt_length", "token_estimate", "tokens_used")
ABOVE_MEDIAN = ("instruction_density", "complexity_score")


def transactions(df: DataFrame, categories: tuple[str, ...] = (), score: str = "success_rate") -> DataFrame:
    """One array of item names per row (rows without items drop out).

    A flag gives `name=1`, a category `name_value=1`, a high number `name_high`, a score above 0.5 `success_high`.
    The thresholds are computed once for the table.
    """
    items: list[Column] = [F.when(F.col(name).cast("boolean"), f"{name}=1") for name in FLAG_ITEMS if name in df.columns]
    items += [F.concat(F.lit(f"{name}_"), F.col(name), F.lit("=1")) for name in categories]
    marks = {name: [0.75] for name in ABOVE_UPPER_QUARTILE} | {name: [0.5] for name in ABOVE_MEDIAN}
    thresholds = exact_quantiles(df, {name: p for name, p in marks.items() if name in df.columns})
    items += [F.when(F.col(name) > threshold, f"{name}_high") for name, [threshold] in thresholds.items()]
    items.append(F.when(F.col(score) > 0.5, "success_high"))
    return df.select(F.array_sort(F.array_compact(F.array(*items))).alias("items")).where(F.size("items") > 0)


def frequent_itemsets(baskets: DataFrame, min_support: float = 0.08, longest: int | None = None) -> DataFrame:
    """(items, freq, support) of all itemsets with at least the support and, if given, at most `longest` items.

    Level by level: candidates of k items are joined from frequent sets that share their first k-2 items, those with a
    rare subset go, and the others are counted where they occur. Work ends with the last level asked for. Baskets keep
    their frequent items only (there are at most mean width / support of those), and equal ones are worked on once, with
    their number as weight; an occurrence carries the items of its basket that may follow, so no level reads the baskets
    again.
    """
    baskets, seen = stored_observed(baskets.select(F.array_distinct("items").alias("items")), "baskets", n=F.count(F.lit(1)))
    total = seen["n"]

    def counted(found: DataFrame) -> tuple[DataFrame, int]:
        sums = found.groupBy("items").agg(F.sum("weight").alias("freq")).withColumn("support", F.col("freq") / max(total, 1))
        rows, seen = stored_observed(sums.where(F.col("support") >= min_support), "itemsets", n=F.count(F.lit(1)))
        return rows, seen["n"]

    one = F.lit(1).cast("bigint").alias("weight")
    level, _ = counted(baskets.select(F.explode("items").alias("item"), one).select(F.array("item").alias("items"), "weight"))
    levels, names = [level], sorted(row["items"][0] for row in level.collect())
    known = F.array_sort(F.array_intersect("items", F.array(*map(F.lit, names)).cast("array<string>")))
    distinct = baskets.select(known.alias("rest")).where(F.size("rest") > 1).groupBy("rest").agg(F.count("*").alias("weight"))
    found = _extended(distinct.withColumn("items", F.array().cast("array<string>")))
    size, left = 1, len(names) > 1
    while (longest is None or size < longest) and left:
        if size > 1:
            found = found.join(level.select("items"), "items", "left_semi")
        found = _extended(found)
        if size > 1:  # all pairs of frequent items are candidates
            found = found.join(_candidates(level, size), "items", "left_semi")
        found, seen = stored_observed(found, "occurrences", rest=F.max(F.size("rest")))
        level, n = counted(found)
        levels.append(level)
        size, left = size + 1, n > 0 and seen["rest"] > 0
    return reduce(DataFrame.unionByName, levels)


def _extended(found: DataFrame) -> DataFrame:
    """Occurrences (weight, items, rest) with one more item: each of the rest, which sorts behind the others."""
    each = found.select("weight", "items", "rest", F.posexplode("rest").alias("at", "added"))
    return each.select("weight", F.concat("items", F.array("added")).alias("items"), F.expr("slice(rest, at + 2, size(rest))").alias("rest"))


def _candidates(level: DataFrame, size: int) -> DataFrame:
    """Sets of size + 1 items, all of whose subsets of `size` (2 or more) items are in the level."""
    sides = level.select(F.slice("items", 1, size - 1).alias("prefix"), F.element_at("items", -1).alias("last"))
    joined = sides.join(sides.withColumnRenamed("last", "later"), "prefix").where("last < later")
    joined = joined.select(F.concat("prefix", F.array("last", "later")).alias("items"))
    # The subsets without the last or the last but one are the two that were joined.
    parts = F.transform(F.sequence(F.lit(0), F.lit(size - 2)), lambda gone: F.filter("items", lambda _, at: at != gone))
    subsets = joined.select("items", F.explode(parts).alias("part"))
    known = subsets.join(level.select(F.col("items").alias("part")), "part", "left_semi")
    return known.groupBy("items").agg(F.count("*").alias("n")).where(F.col("n") == size - 1).select("items")


def _measured(splits: DataFrame) -> DataFrame:
    """Confidence, lift, leverage and conviction (NULL at confidence 1)."""
    confidence = F.col("support") / F.col("antecedent_support")
    with_confidence = splits.withColumn("confidence", confidence)
    gap = 1 - F.col("confidence")
    return with_confidence.select(
        "antecedents",
        "consequents",
        "support",
        "confidence",
        (F.col("confidence") / F.col("consequent_support")).alias("lift"),
        (F.col("support") - F.col("antecedent_support") * F.col("consequent_support")).alias("leverage"),
        F.when(gap > 0, (1 - F.col("consequent_support")) / gap).alias("conviction"),
    )


def all_rules(itemsets: DataFrame, min_confidence: float = 0.0, widest: int | None = None) -> DataFrame:
    """Splits of the itemsets into antecedents and consequents with at least the confidence, with their measures.

    A rule's confidence only falls when an item moves to the right side, so consequents grow item by item from those that
    passed: no subsets are listed, and what is looked up is the rules kept and one item more. A left side that isn't among
    the itemsets (a mined table has them all) gives no rule, but its consequent grows on. `widest` bounds the consequents
    if given.
    """
    left = itemsets.select(F.col("items").alias("antecedents"), F.col("support").alias("antecedent_support"))
    right = itemsets.select(F.col("items").alias("consequents"), F.col("support").alias("consequent_support"))

    def passed(splits: DataFrame) -> tuple[DataFrame, int]:
        sides = splits.withColumn("antecedents", F.array_except("items", "consequents")).join(left, "antecedents", "left")
        confidence = F.col("support") / F.col("antecedent_support")
        kept = sides.where(confidence.isNull() | (confidence >= min_confidence))
        rows, seen = stored_observed(kept, "rules", widest=F.max(F.size("antecedents")))
        return rows, seen["widest"] or 0

    each = F.explode(F.transform("items", lambda item: F.array(item))).alias("consequents")
    level, most = passed(itemsets.where(F.size("items") > 1).select("items", "support", each))
    levels = [level]
    while (widest is None or len(levels) < widest) and most > 1:  # an item that could move is left
        shorter = level.where(F.size("antecedents") > 1).select(
            "items", "support", F.slice("consequents", 1, len(levels) - 1).alias("prefix"), F.element_at("consequents", -1).alias("last")
        )
        wider = shorter.join(shorter.select("items", "prefix", F.col("last").alias("later")), ["items", "prefix"]).where("last < later")
        level, most = passed(wider.select("items", "support", F.concat("prefix", F.array("last", "later")).alias("consequents")))
        levels.append(level)
    known = reduce(DataFrame.unionByName, levels).drop("items").where(F.col("antecedent_support").isNotNull())
    return _measured(known.join(right, "consequents"))


def association_rules(
    itemsets: DataFrame, min_confidence: float = 0.5, min_lift: float = 2.0, fallback_confidence: float = 0.3
) -> DataFrame:
    """Rules above confidence and lift; if none reaches the confidence, the lower one applies."""
    confident = stored(all_rules(itemsets, min_confidence), "rules")
    if confident.isEmpty():
        confident = all_rules(itemsets, fallback_confidence)
    return confident.where(F.col("lift") >= min_lift)


def top_rules(rules: DataFrame, n: int = 50) -> DataFrame:
    """Best lift first (to nine decimals, then confidence, then the sides); the sides as comma-joined text."""
    joined = rules.withColumns(
        {side: F.array_join(side, ", ") for side in ("antecedents", "consequents")}
    )
    return joined.orderBy(F.round("lift", 9).desc(), F.round("confidence", 9).desc(), "antecedents", "consequents").limit(n)


def categorical_rules(
    df: DataFrame, columns: list[str], min_support: float = 0.05, min_confidence: float = 0.6, longest: int = 4
) -> DataFrame:
    """Rules over `column=value` items with one consequent, the empty antecedent included."""
    items = [F.concat(F.lit(f"{name}="), F.col(name).cast("string")) for name in columns]
    baskets = df.select(F.array_sort(F.array_compact(F.array(*items))).alias("items"))
    itemsets = frequent_itemsets(baskets, min_support, longest)
    single = all_rules(itemsets, min_confidence, widest=1)
    alone = itemsets.where(F.size("items") == 1).select(
        F.array().cast("array<string>").alias("antecedents"),
        F.col("items").alias("consequents"),
        "support",
        F.lit(1.0).alias("antecedent_support"),
        F.col("support").alias("consequent_support"),
    )
    return single.unionByName(_measured(alone)).where(F.col("confidence") >= min_confidence)


def rule_stats(rules: DataFrame, n: int = 50) -> DataFrame:
    """Count and mean confidence, lift and support, for all rules and for the best n."""

    def means(part: DataFrame, scope: str) -> DataFrame:
        return part.agg(
            F.lit(scope).alias("scope"),
            F.count("*").alias("rules"),
            F.avg("confidence").alias("avg_confidence"),
            F.avg("lift").alias("avg_lift"),
            F.avg("support").alias("avg_support"),
        )

    return means(rules, "all").unionByName(means(top_rules(rules, n), "top"))


def rule_lookup(rules: DataFrame, limit: int = 20) -> DataFrame:
    """The best rules for display, each with the mean confidence of the page."""
    page = top_rules(rules, limit)
    return page.withColumn("avg_confidence", F.avg("confidence").over(Window.partitionBy()))
