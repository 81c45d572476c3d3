"""Exact order statistics without putting a large group into one task.

Values are counted first (one row per distinct value, combined map-side). The ordered step then works on coarse
value bins, and only the bins that hold a wanted rank are ordered value by value.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnlake.session import stored

SCORE_BINS = 4096  # bins per unit of a score; scores lie in [0, 1]
ORDER_BITS = 60  # bits of a hash order
HASH_BITS = 12  # 4096 equally likely hash bins


def score_bin(score: Column) -> Column:
    return F.floor(score * SCORE_BINS)


def score_counts(df: DataFrame, keys: list[str], score: str = "success_score") -> DataFrame:
    """Rows per (keys, score): a hot key shrinks to its distinct scores before anything is joined or ordered."""
    return df.where(F.col(score).isNotNull()).groupBy(*keys, score).agg(F.count("*").alias("weight"))


def score_summary(counts: DataFrame, keys: list[str], score: str = "success_score") -> DataFrame:
    """Per key: `n`, `mean` and exact `median` of scores counted by `score_counts`. Value bins of one key are ordered in
    parallel, so a hot key with many distinct scores is never ordered in one task.
    """
    levels = counts.groupBy(*keys, F.col(score).alias("v")).agg(F.sum("weight").alias("w"))
    low, high = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)

    def holds(rank: Column) -> Column:
        return (F.col("before") <= rank) & (rank < F.col("before") + F.col("w"))

    def placed(rows: DataFrame, by: list[str], order: str, total: Column) -> DataFrame:
        whole = Window.partitionBy(*by)
        so_far = whole.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumns(
            {
                "n": F.sum("w").over(whole),
                "total": F.sum(total).over(whole),
                "before": F.sum("w").over(so_far) - F.col("w"),
            }
        )

    def median(rows: DataFrame) -> DataFrame:
        hits = [F.max(F.when(holds(rank), F.col("v"))) for rank in (low, high)]
        return rows.groupBy(*keys).agg(
            F.max("n").alias("n"),
            (F.max("total") / F.max("n")).alias("mean"),
            ((hits[0] + hits[1]) / 2).alias("median"),
        )

    binned = levels.withColumn("bin", score_bin(F.col("v")))
    bins = binned.groupBy(*keys, "bin").agg(F.sum("w").alias("w"), F.sum(F.col("v") * F.col("w")).alias("vw"))
    wanted = placed(bins, keys, "bin", F.col("vw")).where(holds(low) | holds(high)).drop("w", "vw")
    # Null-safe on purpose: an ordinary equality would push null filters into one side only, and the two sides
    # could no longer share the one exchange (and the one scan) that `levels` comes from.
    sides = [*keys, "bin"]
    marks = wanted.withColumnsRenamed({name: f"_{name}" for name in sides})
    same = reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in sides])
    inside = binned.join(marks, same).drop(*[f"_{name}" for name in sides])
    in_bin = Window.partitionBy(*sides).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    return median(inside.withColumn("before", F.col("before") + F.sum("w").over(in_bin) - F.col("w")))


def exact_quantiles(
    df: DataFrame, wanted: dict[str, list[float]], bins: int = 1024
) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns with linear interpolation, in three passes over those columns.

    Approximate quantiles only place the bin borders; counts per bin (at most `bins` rows per column reach the
    driver) then name the bins that hold the wanted ranks, and only the distinct values of those are ordered.
    """
    names = list(wanted)
    values = df.select(*[F.nanvl(F.col(name).cast("double"), F.lit(None)).alias(f"v{i}") for i, name in enumerate(names)])
    shares = [i / bins for i in range(1, bins)]
    row = values.agg(*[F.percentile_approx(f"v{i}", shares, 10 * bins).alias(f"b{i}") for i in range(len(names))]).first()
    borders = [[-math.inf, *sorted(set(row[f"b{i}"] or [0.0])), math.inf] for i in range(len(names))]
    places = range(len(names))
    binned = Bucketizer(
        splitsArray=borders,
        inputCols=[f"v{i}" for i in places],
        outputCols=[f"bin{i}" for i in places],
        handleInvalid="keep",  # a missing value gets a bin of its own and is dropped below
    ).transform(values)
    cells = [F.struct(F.lit(i).alias("c"), F.col(f"bin{i}").alias("bin"), F.col(f"v{i}").alias("v")) for i in places]
    long = binned.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").where(F.col("v").isNotNull())

    sizes: dict[int, dict[float, int]] = {i: {} for i in places}
    for c, b, n in long.groupBy("c", "bin").agg(F.count("*").alias("n")).collect():
        sizes[c][b] = n
    targets = {}  # (column, rank) -> (bin, rank inside the bin)
    ranks: dict[int, list[float]] = {}
    for i, name in enumerate(names):
        total = sum(sizes[i].values())
        ranks[i] = [p * (total - 1) for p in wanted[name]] if total else []
        for rank in {r for place in ranks[i] for r in (math.floor(place), math.ceil(place))}:
            start = 0
            for b in sorted(sizes[i]):
                if rank < start + sizes[i][b]:
                    targets[i, rank] = (b, rank - start)
                    break
                start += sizes[i][b]
    if not targets:
        return {name: [None] * len(wanted[name]) for name in names}

    in_bins = {(i, b) for (i, _), (b, _) in targets.items()}
    hit = reduce(Column.__or__, [(F.col("c") == i) & (F.col("bin") == b) for i, b in sorted(in_bins)])
    counted = long.where(hit).groupBy("c", "bin", "v").agg(F.count("*").alias("w"))
    in_bin = Window.partitionBy("c", "bin").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ordered = counted.withColumn("upto", F.sum("w").over(in_bin))
    picks = [
        F.min(F.when((F.col("c") == i) & (F.col("bin") == b) & (F.col("upto") > inside), F.col("v"))).alias(f"r{i}_{rank}")
        for (i, rank), (b, inside) in targets.items()
    ]
    found = ordered.agg(*picks).first()

    def at(i: int, place: float) -> float:
        low, high = found[f"r{i}_{math.floor(place)}"], found[f"r{i}_{math.ceil(place)}"]
        return low + (high - low) * (place - math.floor(place))

    return {name: [at(i, place) for place in ranks[i]] or [None] * len(wanted[name]) for i, name in enumerate(names)}


def hash_order(key: Column, seed: int) -> Column:
    """A reproducible random order that any SQL engine can repeat: the first 60 bits of the SHA-256 of `seed:key`."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)
    return F.conv(F.left(digest, F.lit(ORDER_BITS // 4)), 16, 10).cast("bigint")


def with_split(
    df: DataFrame, key: str, shares: dict[str, float], seed: int = 42, strata: str | None = None
) -> DataFrame:
    """Add `split` with exact group sizes: a cut of the hash order, per stratum if one is given.

    Every stratum is cut at the rounded-up cumulative shares. Counts per hash bin (at most 4096 per stratum) name the
    bins that a cut goes through; only keys of those bins are ranked, which gives the first row of every part. The
    table itself is then read once and compared with those rows in place. What is joined is stored first, so the
    optimizer knows its size: a few strata are sent along with the rows, many are joined.
    """
    stratum = F.col(strata) if strata else F.lit(0)
    keys = df.select(stratum.alias("_stratum"), F.col(key).alias("_key"), hash_order(F.col(key), seed).alias("_hash"))
    keys = keys.withColumn("_bin", F.shiftright("_hash", ORDER_BITS - HASH_BITS))
    whole = Window.partitionBy("_stratum")
    so_far = whole.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = keys.groupBy("_stratum", "_bin").agg(F.count("*").alias("_size"))
    bins = bins.withColumns(
        {"_before": F.sum("_size").over(so_far) - F.col("_size"), "_total": F.sum("_size").over(whole)}
    )

    names = list(shares)
    sums = [sum(list(shares.values())[: i + 1]) for i in range(len(names) - 1)]
    cuts = [F.ceil(F.round(F.col("_total") * s, 6)) for s in sums]
    crossed = reduce(Column.__or__, [(F.col("_before") <= c) & (c < F.col("_before") + F.col("_size")) for c in cuts])
    near = keys.join(stored(bins.where(crossed), "split-bins"), ["_stratum", "_bin"])
    in_bin = Window.partitionBy("_stratum", "_bin").orderBy("_hash", "_key")
    ranked = near.withColumn("_rank", F.col("_before") + F.row_number().over(in_bin) - 1)
    place = F.struct("_bin", "_hash", "_key")
    firsts = ranked.groupBy("_stratum").agg(
        *[F.min(F.when(F.col("_rank") == cut, place)).alias(f"_first{i}") for i, cut in enumerate(cuts)]
    )

    hashed = hash_order(F.col(key), seed)
    mine = F.struct(F.shiftright(hashed, ORDER_BITS - HASH_BITS).alias("_bin"), hashed.alias("_hash"), F.col(key).alias("_key"))
    placed = df.withColumns({"_stratum": stratum, "_place": mine}).join(stored(firsts, "split-cuts"), "_stratum", "left")
    split = F.when(F.col("_first0").isNull() | (F.col("_place") < F.col("_first0")), names[0])
    for i, name in enumerate(names[1:-1], start=1):
        split = split.when(F.col(f"_first{i}").isNull() | (F.col("_place") < F.col(f"_first{i}")), name)
    return placed.withColumn("split", split.otherwise(names[-1])).select(*df.columns, "split")


def first_rows(df: DataFrame, order: Column, ties: list[Column], n: int, low_bits: int = 32) -> DataFrame:
    """The n rows with the smallest `order` (a number; NULL and NaN come last), then the smallest `ties`; all rows if
    there are fewer.

    Two scans: one counts rows by the order's high bits (all but `low_bits` of a whole number; steps of a logarithm of any
    other), which tells the bin that the n-th row lies in; one takes the bins below it whole and ranks the rows of that
    bin alone. Bins beyond the order's range don't exist, and their counts are added up in one small window.
    """
    ranked = df.withColumn("_order", order)
    value, none = F.col("_order"), F.lit(2**63 - 1)
    if ranked.schema["_order"].dataType.typeName() in ("byte", "short", "integer", "long"):
        bins = F.shiftright(value.cast("bigint"), low_bits)
    else:
        value = F.nanvl(value.cast("double"), F.lit(None))
        bins = F.floor(F.signum(value) * F.log2(F.abs(value) + 1) * 4096)
    ranked = ranked.withColumns({"_order": value, "_bin": F.coalesce(bins, none)})
    counts = ranked.groupBy("_bin").agg(F.count("*").alias("size"))
    upto = F.sum("size").over(Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0))
    cut = counts.withColumn("before", upto - F.col("size")).where((F.col("before") < n) & (F.col("before") + F.col("size") >= n)).first()
    by = [F.asc_nulls_last("_order"), *ties]
    if cut is None:  # nothing is asked for, or all there is
        found = ranked.limit(0) if n <= 0 else ranked
    else:
        inside = ranked.where(F.col("_bin") == cut["_bin"]).orderBy(*by).limit(n - cut["before"])
        found = ranked.where(F.col("_bin") < cut["_bin"]).unionByName(inside)
    return found.orderBy(*by).select(*df.columns)
