"""Ordered scans over tables of any size: a range shuffle, one pass over each partition, and a small table of what the
partitions before it hold.

No window runs over a key, so a key with a third of all rows, or an order with gaps, is no different from any other: a
window's group here is a range partition, which holds about 1/n of the rows whatever the keys are. The summary table has one
row per partition; that bounds the windows and broadcasts over it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from turnlake.session import stored

_ROWS = 33  # bits of a place that count the rows of a partition


def laid(df: DataFrame, order: Sequence[Column | str], name: str = "laid") -> DataFrame:
    """The rows in the order, written once, with `part` (the range partition) and `place` (ascending in the order).

    Rows that are equal in all columns of the order get places of their own, so an order with a tie-break is the caller's
    to give where it matters.
    """
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    return stored(rows, name).withColumn("part", F.shiftright("place", _ROWS).cast("int"))


def _before(parts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For each partition the sums of the partitions before it; one row per partition."""
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"before_{c}") for c in columns]
    return F.broadcast(parts.select("part", *sums))


def ranked(rows: DataFrame) -> DataFrame:
    """`laid` rows with `rank`: 0, 1, 2, ... without gaps."""
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    within = F.col("place") - F.shiftleft(F.col("part").cast("long"), _ROWS)
    return rows.join(_before(parts, ["n"]), "part").withColumn("rank", within + F.col("before_n")).drop("before_n")


def running(rows: DataFrame, columns: Sequence[str], totals: bool = False) -> DataFrame:
    """`laid` rows with `running_<column>`: the sum of the column over this row and all before it; with `totals`, also
    `total_<column>` over all rows.
    """
    parts = rows.groupBy("part").agg(*(F.sum(c).alias(c) for c in columns))
    here = W.partitionBy("part").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    before = _before(parts, columns)
    if totals:
        every = parts.withColumns({f"total_{c}": F.sum(c).over(W.partitionBy()) for c in columns}).drop(*columns)
        before = F.broadcast(before.join(F.broadcast(every), "part"))
    sums = rows.withColumns({f"running_{c}": F.sum(c).over(here) for c in columns}).join(before, "part")
    return sums.withColumns({f"running_{c}": F.col(f"running_{c}") + F.col(f"before_{c}") for c in columns}).drop(*(f"before_{c}" for c in columns))


def walked(rows: DataFrame, key: str, ahead: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """`laid` rows (ordered by the key first) with what one walk along them tells: `next_<column>` of the row after for the
    columns `ahead` (NULL on the last row of all), the measures, which may use those, and `running_<measure>`, sums that
    start anew at every key. For narrow columns.

    In a partition the sum before the key's first row is taken off. The first and last rows of the partitions, one of each,
    tell what comes after a partition and what its first key has in earlier ones.
    """
    here, in_order = W.partitionBy("part").orderBy("place"), W.orderBy("part")
    upto = here.rowsBetween(W.unboundedPreceding, 0)
    firsts = rows.where(F.col("place") == F.shiftleft(F.col("part").cast("long"), _ROWS))
    if ahead:
        after = firsts.select("part", F.lead(F.struct(*ahead)).over(in_order).alias("after_part"))
        rows = rows.withColumn("after", F.lead(F.struct(*ahead)).over(here)).join(F.broadcast(after), "part")
        found = F.coalesce("after", "after_part")
        rows = rows.withColumns({f"next_{c}": found[c] for c in ahead}).drop("after", "after_part")
    names = list(measures)
    rows = rows.withColumns(measures)
    begins = F.lag("place").over(here).isNull() | ~F.col(key).eqNullSafe(F.lag(key).over(here))
    sums = {f"running_{c}": F.sum(c).over(upto) for c in names}
    rows = rows.withColumns({"begins": begins, "ends": F.lead("place").over(here).isNull()} | sums)
    base = {c: F.last(F.when(F.col("begins"), F.col(f"running_{c}") - F.col(c)), ignorenulls=True).over(upto) for c in names}
    rows = rows.withColumns({f"running_{c}": F.col(f"running_{c}") - base[c] for c in names}).drop("begins")

    chain = rows.where("ends").select("part", F.col(key).alias("last_key"), *(F.col(f"running_{c}").alias(f"tail_{c}") for c in names))
    chain = chain.join(F.broadcast(firsts.select("part", F.col(key).alias("first_key"))), "part")
    same_key = W.partitionBy("last_key").orderBy("part").rowsBetween(W.unboundedPreceding, 0)
    chain = chain.withColumns({f"tail_{c}": F.sum(f"tail_{c}").over(same_key) for c in names})
    goes_on = F.lag("part").over(in_order).isNotNull() & F.col("first_key").eqNullSafe(F.lag("last_key").over(in_order))
    carried = chain.select("part", "first_key", *(F.when(goes_on, F.lag(f"tail_{c}").over(in_order)).alias(f"carried_{c}") for c in names))
    begun = F.col(key).eqNullSafe(F.col("first_key"))
    total = {f"running_{c}": F.col(f"running_{c}") + F.when(begun, F.coalesce(f"carried_{c}", F.lit(0))).otherwise(0) for c in names}
    return rows.drop("ends").join(F.broadcast(carried), "part").withColumns(total).drop("first_key", *(f"carried_{c}" for c in names))


def running_within(rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """`laid` rows (ordered by the key first) with `running_<column>`: sums that start anew at every key."""
    return walked(rows, key, [], {c: F.col(c) for c in columns})
