"""Near-duplicates by 64-bit SimHash and a hierarchical index over fingerprints in Gray order.

Two fingerprints that differ in at most two bits agree on at least one of three blocks of bits. So every distinct
fingerprint goes to three groups, one per block; a group that is larger than `LEAF` is divided again in the same way on
the bits that are left, until all groups are leaves. After five divisions at most ten bits are left, so every chain ends;
no link is lost at any group size, and no task gets more than a leaf at a time.

In a leaf, fingerprints are sorted by Gray rank (neighbours then share most bits). Runs of `RUN` form nodes with the
bits that all their members share; runs of nodes form upper nodes. A pair of nodes whose shared bits already differ
more than the limit is dropped with everything below it. Leaves give links that span their components, not all pairs.

A text without words has the fingerprint zero and is linked like any other. Null texts count as empty; rows with a null
id are linked, but their `component_id` is null if no linked row has an id. Repeated rows give repeated results. Texts of
any length are read whole, and an empty table gives no rows. Only `doc_id` and `text` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlake.llm.components import components
from turnlake.llm.words import batches, fresh, id_type, record, schema, space_words, text_bytes
from turnlake.session import stored

SHINGLE = 3
LIMIT = 2
LEAF = 16_384
RUN = 64
_LANES = np.uint64(0x0101010101010101)


def _hashes(text: bytes, width: int) -> list[int]:
    words = space_words(text)
    if not words:
        return []
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    joined, ends = b" ".join(words), np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1])).tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[i:j], 42) for i, j in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=False)]


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set: eight byte lanes at a time, 255 hashes before a lane could overflow."""
    padded = np.zeros(-(-len(hashes) // 255) * 255, np.uint64)
    padded[: len(hashes)] = hashes
    out = np.zeros(64, np.int64)
    for bit in range(8):
        lanes = ((padded >> np.uint64(bit)) & _LANES).reshape(-1, 255).sum(axis=1, dtype=np.uint64)
        out[bit::8] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return out


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes; no words: zero."""
    hashes = np.array(_hashes(text, width), np.uint64)
    if not len(hashes):
        return 0
    bits = np.flatnonzero(_bit_counts(hashes) * 2 > len(hashes))
    return sum(1 << int(b) for b in bits)


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """`doc_id, fp` (as a signed long) for every row."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream, 1000):
            found = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], np.uint64)
            yield record({"doc_id": batch.column(0), "fp": pa.array(found.view(np.int64))})

    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(run, schema(("doc_id", id_type(docs)), ("fp", "bigint")))


def gray_rank(fp: Column) -> Column:
    """The place of a bit pattern in the reflected Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


def _blocks(left: int) -> list[int]:
    """The set bits of `left` in three masks."""
    bits = [b for b in range(64) if left >> b & 1]
    cuts = [round(i * len(bits) / 3) for i in range(4)]
    return [sum(1 << b for b in bits[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def leaves(distinct: DataFrame, leaf: int = LEAF) -> DataFrame:
    """`path, key, fp`: groups of at most `leaf` fingerprints, in which every pair within the limit meets at least once."""
    everything = (1 << 64) - 1
    rows, paths, out = distinct.select(F.lit(0).alias("path"), "fp"), {0: everything}, None
    while True:
        below = {path * 3 + i + 1: left & ~block for path, left in paths.items() for i, block in enumerate(_blocks(left))}
        taken = F.create_map(  # for each path its three children, with all bits on which a child's groups agree
            *(x for path in paths for x in (F.lit(path), F.array(*(F.struct(F.lit(c).alias("path"), F.lit(_signed(everything & ~below[c])).alias("mask")) for c in range(path * 3 + 1, path * 3 + 4)))))
        )
        dealt = rows.select(F.explode(taken[F.col("path")]).alias("at"), "fp").select("at.path", F.col("fp").bitwiseAND(F.col("at.mask")).alias("key"), "fp")
        large = stored(dealt.groupBy("path", "key").count().where(F.col("count") > leaf).select("path", "key"), "large-groups")
        seen = [row["path"] for row in large.select("path").distinct().collect()]  # at most 3 to the depth
        if not seen:
            return dealt if out is None else out.unionByName(dealt)
        small = dealt.join(large, ["path", "key"], "left_anti")
        out = small if out is None else out.unionByName(small)
        rows = stored(dealt.join(large, ["path", "key"], "left_semi").select("path", "fp"), "divided-groups")
        paths = {p: below[p] for p in seen}


def _node_pairs(fps: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Pairs of runs whose shared bit patterns are close enough, found from upper nodes down."""

    def shared(low: np.ndarray, high: np.ndarray, fan: int) -> tuple[np.ndarray, np.ndarray]:
        cuts = np.arange(0, len(low), fan)
        return np.bitwise_and.reduceat(low, cuts), np.bitwise_or.reduceat(high, cuts)

    def close(a: tuple, b: tuple) -> np.ndarray:
        """Accumulated differences on the bits that both nodes hold fixed."""
        fixed = ~(a[0] ^ a[1])[:, None] & ~(b[0] ^ b[1])[None, :]
        return np.bitwise_count((a[0][:, None] ^ b[0][None, :]) & fixed) <= limit

    runs = shared(fps, fps, RUN)
    fan = 16
    upper = shared(*runs, fan)
    for i, j in zip(*np.nonzero(np.triu(close(upper, upper))), strict=True):
        a, b = slice(i * fan, (i + 1) * fan), slice(j * fan, (j + 1) * fan)
        for x, y in zip(*np.nonzero(close((runs[0][a], runs[1][a]), (runs[0][b], runs[1][b]))), strict=True):
            if i * fan + x <= j * fan + y:
                yield int(i * fan + x), int(j * fan + y)


def leaf_links(fps: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Links (as positions) that span the components of one leaf; `fps` is sorted by Gray rank."""
    label = np.arange(len(fps))
    for x, y in _node_pairs(fps, limit):
        a, b = fps[x * RUN : (x + 1) * RUN], fps[y * RUN : (y + 1) * RUN]
        la, lb = label[x * RUN : (x + 1) * RUN], label[y * RUN : (y + 1) * RUN]
        if la[0] == lb[0] and (la == la[0]).all() and (lb == la[0]).all():
            continue
        i, j = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= limit)
        i, j = i + x * RUN, j + y * RUN
        while len(i):
            apart = label[i] != label[j]
            i, j = i[apart], j[apart]
            if len(i):
                low, high = sorted((label[i[0]], label[j[0]]))
                label[label == high] = low
    away = np.flatnonzero(label != np.arange(len(fps)))
    return away, label[away]


def _group_links(group: np.ndarray, fps: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of many whole groups that lie one after another: small ones all at once, larger ones by the index."""
    cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.concatenate((cuts, [len(fps)])))
    size_of = np.repeat(sizes, sizes)
    a_parts, b_parts = [], []
    small = size_of <= RUN
    for step in range(1, int(sizes[sizes <= RUN].max(initial=1))):
        near = np.flatnonzero(small[:-step] & (group[step:] == group[:-step]))
        near = near[np.bitwise_count(fps[near] ^ fps[near + step]) <= limit]
        a_parts.append(near + step)
        b_parts.append(near)
    for cut, size in zip(cuts[sizes > RUN], sizes[sizes > RUN], strict=True):
        a, b = leaf_links(fps[cut : cut + size], limit)
        a_parts.append(a + cut)
        b_parts.append(b + cut)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *a_parts]), np.concatenate([none, *b_parts])


def links(distinct: DataFrame, limit: int = LIMIT, leaf: int = LEAF) -> DataFrame:
    """`a, b`: links between distinct fingerprints `fp` that join all pairs within the limit into the same components."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((3, 0), np.int64)

        def found(rows: np.ndarray) -> pa.RecordBatch:
            path, key, fps = rows
            turn = np.concatenate(([False], (path[1:] != path[:-1]) | (key[1:] != key[:-1])))
            i, j = _group_links(np.cumsum(turn), fps.view(np.uint64), limit)
            return record({"a": pa.array(fps[i]), "b": pa.array(fps[j])})

        for batch in stream:
            rows = np.concatenate((rest, np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)])), axis=1)
            last = np.flatnonzero((rows[0] != rows[0, -1]) | (rows[1] != rows[1, -1])) if rows.shape[1] else []
            whole = last[-1] + 1 if len(last) else 0  # the last group may go on in the next batch
            if whole:
                yield found(np.ascontiguousarray(rows[:, :whole]))
            rest = rows[:, whole:]
        if rest.shape[1]:
            yield found(np.ascontiguousarray(rest))

    if limit != LIMIT:
        raise ValueError("three blocks find pairs that differ in at most two bits")
    dealt = leaves(distinct, leaf).repartition("path", "key").sortWithinPartitions("path", "key", gray_rank(F.col("fp")))
    return dealt.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """`doc_id, fingerprint, component_id` for every row: the smallest id that is reachable over links."""
    rows = stored(fingerprints(docs, width), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = stored(components(links(distinct.select("fp"))), "fingerprint-roots")
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = named.join(least, "root").select("fp", "component_id")
    return rows.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """One row of each component: the one with the smallest id, and of that id's texts the one with the smallest digest.

    A row is named by id and text, so different texts that share an id, or have none, stay apart; a row without an id
    stays only if no linked row has one. Rows with the same id and text count once.
    """
    id_name, text_name = fresh(docs, "stays"), fresh(docs, "stays_text")
    digest = F.unhex(F.sha2(F.col("text"), 256))
    name = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), digest.alias("digest"))
    found = near_duplicates(docs.select(name.alias("doc_id"), "text"), width)
    stays = found.select(F.col("component_id.id").alias(id_name), F.col("component_id.digest").alias(text_name)).distinct()
    keyed = docs.withColumn(own := fresh(docs, "text_digest"), digest)
    same = F.col("doc_id").eqNullSafe(F.col(id_name)) & F.col(own).eqNullSafe(F.col(text_name))
    return keyed.join(stays, same, "left_semi").dropDuplicates(["doc_id", own]).drop(own)
