"""Connected components of a link table by alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnlake.session import stored


def _stars(links: DataFrame, both: bool) -> DataFrame:
    """Every node ties the neighbours in question to the least node around it."""
    sides = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if both:
        sides = sides.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = sides.join(least, "u")
    if both:  # the neighbours above the node
        out = tied.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:  # the node itself and its neighbours below
        out = tied.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """`node, root` for every node of `links(a, b)`; the root is the component's least node.

    Rounds are written to the shared folder, so lost executors cost one round at most; their number grows with the
    logarithm of the component size. Sums are combined map-side; the joins have one row per node on one side, so a hub
    is split as a skewed join. Self-links and repeated links do no harm.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, before = stored(links, "links"), None
    while True:
        links = stored(_stars(_stars(links, True), False), "links")
        mark = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
