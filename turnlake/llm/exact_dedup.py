"""Exact deduplication of batches against immutable snapshots.

Every batch is first grouped by itself. Its distinct texts are screened by the static binary-fuse filters of the earlier
snapshots; only texts that pass a filter are joined with that snapshot's exact buckets, by byte length and 256-bit digest.
Texts that are in no snapshot become the next snapshot, which is written once and never changed: repeats found later are kept
as increments beside it. At last the bytes decide: every row of a group of several meets the text of the group's first row,
and rows that differ from it form groups of their own, which are compared in the same way until none differs.

A filter covers one bucket of digests (`BUCKET` keys on average), so filters are built and asked in many tasks, and no
task or broadcast holds a whole snapshot. Digests are shuffled, and the texts of rows that have a partner: one join by row,
one with the group's first text, in which a hot group is split like any skewed key.

Null texts count as empty. Rows with the same id and the same text all carry the same result. Null ids count in
`group_size`; a group of null ids only has a null `keep_id` and keeps those rows. Only `doc_id` and `text` are read, so
other columns may have any name; the table must give its rows in the same order when read again, as files do. An empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnlake.session import stored

BUCKET = 65_536  # keys per filter, on average
_SEEDS = 64


@dataclass(frozen=True)
class FuseFilter:
    """A binary-fuse filter of 8-bit fingerprints with three slots per key."""

    seed: int
    segment: int
    span: int
    slots: np.ndarray

    def contains(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.slots):
            return np.zeros(len(keys), bool)
        mixed = _mixed(keys, self.seed)
        a, b, c = _places(mixed, self.segment, self.span)
        return (self.slots[a] ^ self.slots[b] ^ self.slots[c]) == _fingerprints(mixed)


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A bijective 64-bit mix of key and seed."""
    x = keys.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _fingerprints(mixed: np.ndarray) -> np.ndarray:
    return ((mixed ^ (mixed >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)


def _places(mixed: np.ndarray, segment: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One slot in each of three neighbouring segments."""
    mask = np.uint64(segment - 1)
    first = ((mixed >> np.uint64(32)) * np.uint64(span)) >> np.uint64(32)
    second = (first + np.uint64(segment)) ^ ((mixed >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment)) ^ (mixed & mask)
    return first.astype(np.int64), second.astype(np.int64), third.astype(np.int64)


def build_filter(keys: np.ndarray) -> FuseFilter:
    """Peels keys that are alone in a slot, round by round, and assigns the slots in the opposite order."""
    keys = np.unique(keys.astype(np.uint64))
    n = len(keys)
    if not n:
        return FuseFilter(0, 1, 0, np.zeros(0, np.uint8))
    segment = 4 if n < 4 else 1 << min(18, int(math.log(n) / math.log(3.33) + 2.25))
    factor = max(1.125, 0.875 + 0.25 * math.log(1_000_000) / math.log(max(n, 2)))
    for seed in range(_SEEDS):
        count = max(1, math.ceil(n * factor / segment) - 2)
        span = count * segment
        mixed = _mixed(keys, seed)
        places = np.stack(_places(mixed, segment, span))
        order = _peeled(places, n, span + 2 * segment)
        if order is not None:
            slots = np.zeros(span + 2 * segment, np.uint8)
            prints = _fingerprints(mixed)
            for members, at in reversed(order):
                a, b, c = places[:, members]
                slots[at] = prints[members] ^ slots[a] ^ slots[b] ^ slots[c]  # slots[at] itself is still zero
            return FuseFilter(seed, segment, span, slots)
        factor *= 1.02
    raise RuntimeError("no seed peels the keys")


def _peeled(places: np.ndarray, n: int, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    load = np.bincount(places.ravel(), minlength=size)
    total = np.zeros(size, np.int64)  # sum of the keys' numbers in a slot: with one key left, that key
    for row in places:
        np.add.at(total, row, np.arange(n))
    order, left = [], n
    alone = np.flatnonzero(load == 1)
    while len(alone):
        members, first = np.unique(total[alone], return_index=True)
        order.append((members, alone[first]))
        left -= len(members)
        touched = places[:, members]
        np.subtract.at(load, touched.ravel(), 1)
        np.subtract.at(total, touched.ravel(), np.tile(members, 3))
        near = np.unique(touched.ravel())
        alone = near[load[near] == 1]
    return order if left == 0 else None


@dataclass(frozen=True)
class Snapshot:
    """Immutable: distinct texts (`digest, text_sha256, n_bytes, keep_id, group_size`) and the filters of its buckets."""

    groups: DataFrame
    filters: DataFrame
    bits: int


def digests(docs: DataFrame, *more: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        *more,
        "doc_id",
        F.xxhash64(text).alias("digest"),
        F.sha2(text, 256).alias("text_sha256"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )


def grouped(rows: DataFrame) -> DataFrame:
    """The duplicates inside one batch."""
    return rows.groupBy("digest", "text_sha256", "n_bytes").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )


def _bucket(bits: int):
    return F.shiftrightunsigned("digest", 64 - bits) if bits else F.lit(0).cast("long")


def take_snapshot(groups: DataFrame, name: str = "snapshot") -> Snapshot:
    """Writes the distinct texts and one filter for each of their buckets."""
    groups = stored(groups, name)
    bits = max(0, math.ceil(math.log2(max(1, groups.count()) / BUCKET)))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        made = build_filter(part["digest"].to_numpy().view(np.uint64))
        return pd.DataFrame(
            {"bucket": [part["bucket"].iloc[0]], "seed": [made.seed], "segment": [made.segment], "span": [made.span], "slots": [made.slots.tobytes()]}
        )

    filters = groups.select(_bucket(bits).alias("bucket"), "digest").groupBy("bucket").applyInPandas(
        build, "bucket long, seed long, segment long, span long, slots binary"
    )
    return Snapshot(groups, stored(filters, f"{name}-filters"), bits)


def screened(groups: DataFrame, snapshot: Snapshot, size: int) -> DataFrame:
    """The digests that pass the snapshot's filters: all that it holds, and about one in 256 of the others.

    Large batches ask each filter in several tasks (`part`), for which the filter row is repeated.
    """
    parts = max(1, math.ceil(size / (BUCKET << snapshot.bits)))

    def ask(asked: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(filters):
            return pd.DataFrame({"digest": np.zeros(0, np.int64)})
        row = filters.iloc[0]
        held = FuseFilter(int(row["seed"]), int(row["segment"]), int(row["span"]), np.frombuffer(row["slots"], np.uint8))
        keys = asked["digest"].to_numpy()
        return pd.DataFrame({"digest": keys[held.contains(keys.view(np.uint64))]})

    incoming = groups.select("digest").distinct().select("digest", _bucket(snapshot.bits).alias("bucket"), F.pmod(F.hash("digest"), F.lit(parts)).alias("part"))
    filters = snapshot.filters.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return incoming.groupBy("bucket", "part").cogroup(filters.groupBy("bucket", "part")).applyInPandas(ask, "digest long")


def absorb(batch: DataFrame, snapshots: Iterable[Snapshot], name: str) -> tuple[DataFrame, DataFrame | None]:
    """(distinct texts of the batch that no snapshot holds, increments for the texts that one does)."""
    groups = stored(grouped(batch), f"{name}-groups")
    snapshots, size, known = list(snapshots), groups.count(), None
    for snapshot in snapshots:
        passed = screened(groups, snapshot, size)
        held = snapshot.groups.select("digest", "text_sha256", "n_bytes")
        found = groups.join(passed, "digest", "left_semi").join(held, ["digest", "text_sha256", "n_bytes"], "left_semi")
        known = found if known is None else known.unionByName(found)
    if known is None:
        return groups, None
    known = stored(known, f"{name}-known")
    return groups.join(known, ["digest", "text_sha256", "n_bytes"], "left_anti"), known


def exact_duplicates(batch_list: list[DataFrame]) -> DataFrame:
    """`text_sha256, n_bytes, keep_id, group_size` of every distinct text of the batches, taken in order.

    Batches have the columns of `digests`. Of equal texts, the row with the largest id is kept. A text's total is its row in
    the one snapshot that holds it and its increments; a text in two snapshots, which a filter would have missed, or an
    increment to none is an error.
    """
    snapshots, increments = [], None
    for number, batch in enumerate(batch_list):
        new, known = absorb(batch, snapshots, f"dedup-{number}")
        snapshots.append(take_snapshot(new, f"dedup-{number}-snapshot"))
        if known is not None:
            increments = known if increments is None else increments.unionByName(known)
    groups = snapshots[0].groups
    for snapshot in snapshots[1:]:
        groups = groups.unionByName(snapshot.groups)
    groups = groups.withColumn("held", F.lit(1))
    if increments is not None:
        groups = groups.unionByName(increments.withColumn("held", F.lit(0)))  # each text: its row in one snapshot and its increments
    wrong = F.raise_error(F.concat(F.lit("not in one snapshot but in "), F.sum("held").cast("string"), F.lit(": text "), F.col("text_sha256")))
    size = F.when(F.sum("held") == 1, F.sum("group_size")).otherwise(wrong.cast("bigint"))
    return groups.groupBy("text_sha256", "n_bytes").agg(F.max("keep_id").alias("keep_id"), size.alias("group_size"))


def byte_classes(docs: DataFrame, rows: DataFrame, totals: DataFrame) -> DataFrame:
    """`row, class` of the rows whose bytes differ from those of their group's first row: 1 for the first other text, 2 for
    the next, and so on. `rows(row, text_sha256, n_bytes)` are the rows of `docs` by number.
    """
    several = stored(totals.where("group_size > 1").select("text_sha256", "n_bytes"), "dedup-several")
    shared = rows.join(several, ["text_sha256", "n_bytes"], "left_semi").select("row", "text_sha256", "n_bytes")
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = digests(texts, "row", "text").select("row", "text", F.col("text_sha256").alias("now"))
    moved = F.raise_error(F.lit("the table gave its rows in another order than before")).cast("string")
    here = F.when(F.col("now") == F.col("text_sha256"), F.col("text")).otherwise(moved)
    left = texts.join(stored(shared, "dedup-shared"), "row").select("row", "text_sha256", "n_bytes", here.alias("text"))
    left, number, found, key = stored(left, "dedup-texts"), 0, None, ["text_sha256", "n_bytes"]
    while True:
        first = left.groupBy(*key).agg(F.min("row").alias("row")).select("row")
        first = stored(left.join(first, "row").select(*key, F.col("text").alias("first")), "dedup-first")
        left = stored(left.join(first, key).where("text <> first").drop("first"), "dedup-differs")
        if left.isEmpty():
            return rows.select("row", F.lit(0).alias("class")).where("false") if found is None else found
        number += 1
        # The rows that differ are of this class or a later one; later rounds overrule.
        ranked = left.select("row", F.lit(number).alias("class"))
        found = ranked if found is None else found.unionByName(ranked).groupBy("row").agg(F.max("class").alias("class"))


def deduplicated(docs: DataFrame, arrivals: int = 3) -> DataFrame:
    """`doc_id, keep_id, group_size, kept, text_sha256` for every row of a table, taken as `arrivals` batches by a hash of the id."""
    rows = digests(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "row")
    rows = stored(rows.withColumn("arrival", F.pmod(F.xxhash64("doc_id"), F.lit(arrivals))), "dedup-digests")
    totals = stored(exact_duplicates([rows.where(F.col("arrival") == i).drop("arrival", "row") for i in range(arrivals)]), "dedup-totals")
    key = ["text_sha256", "n_bytes"]
    classes = stored(byte_classes(docs, rows, totals), "dedup-classes")
    if not classes.isEmpty():  # other texts of the same length and digest: their groups are made anew
        rows = stored(rows.join(classes, "row", "left").withColumn("class", F.coalesce("class", F.lit(0))), "dedup-classed")
        torn = rows.where("class > 0").select(*key).distinct()
        again = rows.join(torn, key, "left_semi").groupBy(*key, "class").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        whole = totals.join(torn, key, "left_anti").withColumn("class", F.lit(0))
        totals, key = stored(whole.unionByName(again), "dedup-totals"), [*key, "class"]
    return rows.join(totals, key).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
