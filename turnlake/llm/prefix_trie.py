r"""Prefix trie of conversations, folded by an Euler tour.

Every conversation is rebuilt first: it takes over the first h turns of the conversation that leads its group of five, and
goes on with its own turns after the first h; h is a checksum of its id. A trie node is a distinct sequence of first turns.

- Nodes: turns are hashed, and a prefix's name is the sum of its turns' hashes with their positions (four sums modulo 2^32),
  which a distributed scan gives for all prefixes at once, however long a conversation is. Equal names of equal depth are
  taken for equal prefixes (128 bits). A node is told by its depth and its smallest member, which lies in no other of that
  depth.
- Tour: each node has an enter and an exit arc; an arc's successor is found from the node's first child and next sibling.
  Siblings are neighbours in one range-ordered table, so a node with a third of all nodes as children is nothing special.
- List ranking: arcs that have the least hash of themselves and both neighbours leave the list (a third of it), and hand
  their length to the arc before them; rounds go on until `FINISH` arcs are left, which one task walks along. The rounds are
  then undone: an arc's distance to the end is its length and its successor's distance.
- Sums: in the order of the tour, running sums of leaves and savings at a node's two arcs differ by its subtree's.

Rows without a conv_id belong to no conversation and are left out. Null roles and texts count as empty. Turns with the same
number are ordered by role and a hash of the text; repeated rows are turns of their own. An empty table gives no nodes. Only
`conv_id, turn, role, text` are read; texts are hashed where they lie and never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlake.llm.words import batches, record
from turnlake.operators.scan import laid, ranked, running
from turnlake.session import stored

GROUP = 5  # conversations that share a leader
SHARED = 9  # turns that are taken over: less than this
FINISH = 16_384  # arcs that one task ranks
CHUNK = 1 << 20  # characters of ids that are handed on at once
LANES = ("s0", "s1", "s2", "s3")
_LOW = 0xFFFFFFFF


def turns(conversations: DataFrame) -> DataFrame:
    """`conv_id, turn, role, d0, d1, size`: the turns with a hash of role and text and the text's bytes."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return conversations.where("conv_id is not null").select(
        "conv_id", "turn", role.alias("role"), digest.alias("digest"), F.octet_length(text).cast("long").alias("size")
    ).select("conv_id", "turn", "role", *(F.conv(F.substring("digest", 1 + 15 * i, 15), 16, 10).cast("long").alias(f"d{i}") for i in range(2)), "size")


def borrowed(conv_id: Column) -> Column:
    """How many turns of its leader a conversation takes over, if the leader has them."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % SHARED).cast("long")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(`conv_id, depth, d0, d1, size` of all rebuilt turns, `conv_id, length` of all conversations)."""
    rows = ranked(laid(turns(conversations), ["conv_id", "turn", "role", "d0", "d1"], "trie-turns"))
    own = stored(rows.groupBy("conv_id").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")), "trie-conversations")
    leader = own.select(F.col("conv_id").alias("leader"), F.col("n").alias("leader_n"))
    own = own.withColumn("h", borrowed(F.col("conv_id"))).withColumn("leader", F.col("conv_id") - F.col("conv_id") % GROUP)
    own = own.join(leader, "leader", "left").withColumn("k", F.least("h", F.coalesce("leader_n", F.lit(0))))
    own = stored(own.withColumn("length", F.col("k") + F.greatest(F.lit(0), F.col("n") - F.col("h"))), "trie-lengths")
    rows = stored(rows.select("conv_id", "rank", "d0", "d1", "size").join(own.select("conv_id", "first", "h", "k"), "conv_id"), "trie-numbered")
    rows = rows.withColumn("at", F.col("rank") - F.col("first") + 1)
    after = rows.where("at > h").select("conv_id", (F.col("at") - F.col("h") + F.col("k")).alias("depth"), "d0", "d1", "size")
    heads = rows.where(F.col("at") < SHARED).select(F.col("conv_id").alias("leader"), F.col("at").alias("depth"), "d0", "d1", "size")
    taken = own.select("conv_id", "leader", "k").join(heads, "leader").where("depth <= k").select(after.columns)
    return after.unionByName(taken), own.select("conv_id", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """`conv_id, depth, size, p0, p1, q0, q1`: each prefix's name p and that of the prefix one turn shorter, q."""
    mixed = turns.withColumn("m0", F.xxhash64("depth", "d0", "d1")).withColumn("m1", F.xxhash64(F.lit(1), "d1", "depth", "d0"))
    halves = [F.shiftrightunsigned("m0", 32), F.col("m0").bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned("m1", 32), F.col("m1").bitwiseAND(F.lit(_LOW))]
    rows = mixed.select("conv_id", "depth", "size", *(x.alias(lane) for x, lane in zip(halves, LANES, strict=True)))
    sums = stored(running(laid(rows, ["conv_id", "depth"], "trie-prefixes"), LANES), "trie-sums")
    start = sums.where("depth = 1").select("conv_id", *((F.col(f"running_{s}") - F.col(s)).alias(f"base_{s}") for s in LANES))
    sums = sums.join(stored(start, "trie-starts"), "conv_id")

    def name(*parts: Column) -> list[Column]:
        low = [x.bitwiseAND(F.lit(_LOW)) for x in parts]
        return [F.shiftleft(low[0], 32).bitwiseOR(low[1]), F.shiftleft(low[2], 32).bitwiseOR(low[3])]

    p = name(*(F.col(f"running_{s}") - F.col(f"base_{s}") for s in LANES))
    q = name(*(F.col(f"running_{s}") - F.col(f"base_{s}") - F.col(s) for s in LANES))
    return sums.select("conv_id", "depth", "size", *(x.alias(c) for x, c in zip([*p, *q], ("p0", "p1", "q0", "q1"), strict=True)))


def trie(rows: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes `node, parent, conv_id, parent_conv_id, depth, n_convs, size`, ends `node, conv_id`)."""
    rows = stored(prefixes(rows), "trie-named")
    found = rows.groupBy("depth", "p0", "p1", "q0", "q1").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("size").alias("size"))
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "p0", "p1")]
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(*zero, F.lit(None).cast("long").alias("q0"), F.lit(None).cast("long").alias("q1"), "conv_id", "n_convs", F.lit(0).cast("long").alias("size"))
    found = stored(found.unionByName(root).withColumn("node", F.monotonically_increasing_id()), "trie-nodes")
    above = found.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), (F.col("depth") + 1).alias("depth"), F.col("p0").alias("q0"), F.col("p1").alias("q1"))
    nodes = found.join(above, ["depth", "q0", "q1"], "left").select("node", "parent", "conv_id", "parent_conv_id", "depth", "n_convs", "size")
    last = rows.join(lengths, "conv_id").where("depth = length").select("conv_id", "depth", "p0", "p1")
    last = stored(last.unionByName(lengths.where("length = 0").select("conv_id", *zero)), "trie-last")
    ends = last.join(found.select("depth", "p0", "p1", "node"), ["depth", "p0", "p1"]).select("node", "conv_id")
    return stored(nodes, "trie-parents"), stored(ends, "trie-ends")


def _enter(node: str) -> Column:
    return F.col(node) * 2


def _exit(node: str) -> Column:
    return F.col(node) * 2 + 1


def tour(nodes: DataFrame) -> DataFrame:
    """`id, next, prev` of the arcs: 2 x node enters it, 2 x node + 1 leaves it."""
    order = ["parent", "conv_id"]
    siblings = stored(ranked(laid(nodes.where("parent is not null").select("parent", "conv_id", "node"), order, "tour-siblings")), "tour-ranked")
    following = siblings.select((F.col("rank") - 1).alias("rank"), F.col("parent").alias("next_parent"), F.col("node").alias("next_node"))
    beside = siblings.select("rank", "parent", "node").join(following, "rank", "full")  # the row before the first has no node
    same = F.col("parent").eqNullSafe(F.col("next_parent"))
    beside = stored(beside, "tour-beside")
    leaves = beside.where("node is not null").select(_exit("node").alias("id"), F.when(same, _enter("next_node")).otherwise(_exit("parent")).alias("next"))
    first = beside.where(F.col("next_node").isNotNull() & ~same).select(F.col("next_parent").alias("node"), _enter("next_node").alias("next"))
    enters = nodes.select("node").join(first, "node", "left").select(_enter("node").alias("id"), F.coalesce("next", _exit("node")).alias("next"))
    last = nodes.where("parent is null").select(_exit("node").alias("id"), F.lit(None).cast("long").alias("next"))
    arcs = stored(enters.unionByName(leaves).unionByName(last), "tour-arcs")
    before = arcs.where("next is not null").select(F.col("next").alias("id"), F.col("id").alias("prev"))
    return stored(arcs.join(before, "id", "left"), "tour")


def _lot(column: str, turn: int) -> Column:
    return F.xxhash64(F.lit(turn), F.col(column))


def _walk(rows: pd.DataFrame) -> pd.DataFrame:
    """Distances to the end of the few arcs that are left."""
    length, before = dict(zip(rows["id"], rows["length"], strict=True)), {}
    for i, following in zip(rows["id"], rows["next"], strict=True):
        before[None if pd.isna(following) else int(following)] = i
    at, total, out = before.get(None), 0, []
    while at is not None:
        total += length[at]
        out.append((at, total))
        at = before.get(at)
    return pd.DataFrame(out, columns=["id", "distance"])


def list_ranks(arcs: DataFrame, finish: int = FINISH) -> DataFrame:
    """`id, rank` of the elements of one linked list `id, next, prev`: how many come before."""
    live, rounds = arcs.select("id", "next", "prev", F.lit(1).cast("long").alias("length")), []
    total = left = live.count()
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    while left > finish:
        turn = len(rounds)
        leaves = F.col("prev").isNotNull() & F.col("next").isNotNull() & (_lot("id", turn) < _lot("prev", turn)) & (_lot("id", turn) < _lot("next", turn))
        live = live.withColumn("leaves", leaves)
        gone = live.where("leaves")
        stay = live.where("not leaves").select("id", "next", "prev", "length", none.alias("new_next"), none.alias("new_prev"))
        to_prev = gone.select(F.col("prev").alias("id"), none.alias("next"), none.alias("prev"), "length", F.col("next").alias("new_next"), none.alias("new_prev"))
        to_next = gone.select(F.col("next").alias("id"), none.alias("next"), none.alias("prev"), zero.alias("length"), none.alias("new_next"), F.col("prev").alias("new_prev"))
        rounds.append(gone.select("id", "next", "length"))
        told = stay.unionByName(to_prev).unionByName(to_next).groupBy("id").agg(
            F.coalesce(F.max("new_next"), F.max("next")).alias("next"), F.coalesce(F.max("new_prev"), F.max("prev")).alias("prev"), F.sum("length").alias("length")
        )
        live = stored(told, "list-round")
        left = live.count()
    known = stored(live.select("id", "next", "length").groupBy().applyInPandas(_walk, "id long, distance long"), "list-walked")
    for gone in reversed(rounds):
        after = known.select(F.col("id").alias("next"), F.col("distance").alias("after"))
        known = stored(known.unionByName(gone.join(after, "next").select("id", (F.col("length") + F.col("after")).alias("distance"))), "list-known")
    return known.select("id", (F.lit(total) - F.col("distance")).alias("rank"))


def folded(nodes: DataFrame) -> DataFrame:
    """`node, n_leaves, saved_tokens` of each node's subtree, from running sums along the tour."""
    children = stored(nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children")), "trie-children")
    weights = nodes.join(children, "node", "left").select(
        _enter("node").alias("id"), F.col("n_children").isNull().cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
    )
    arcs = list_ranks(tour(nodes)).join(weights, "id", "left").select("id", "rank", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("leaf", "saved", "n_children")))
    sums = running(laid(arcs, ["rank"], "tour-ranks"), ["leaf", "saved"])
    leaving = F.col("id") % 2 == 1
    parts = [F.sum(F.when(leaving, F.col(f"running_{c}")).otherwise(F.col(c) - F.col(f"running_{c}"))).alias(out) for c, out in (("leaf", "n_leaves"), ("saved", "saved_tokens"))]
    return sums.groupBy(F.shiftright("id", 1).alias("node")).agg(F.max("n_children").alias("n_children"), *parts)


def end_digests(ends: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """`node, ends_sha256`: SHA-256 of the ids that end at the node, ascending, comma-joined.

    Ids are joined to strings of at most `chunk` characters in the partitions of their range; a node's strings then go
    through one hash, one at a time.
    """

    def strings(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, held, size = None, None, [], 0

        def made() -> pa.RecordBatch:
            return record({"node": pa.array([node], pa.int64()), "first": pa.array([first], pa.int64()), "ids": pa.array([",".join(held)])})

        for batch in batches(stream, 4096):
            for at, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (at != node or size > chunk):
                    yield made()
                    held, size = [], 0
                if not held:
                    node, first = at, conv
                held.append(str(conv))
                size += len(held[-1]) + 1
        if held:
            yield made()

    def hashed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        done: list[tuple[int, str]] = []
        for batch in batches(stream, 16):
            for at, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if at != node:
                    if digest is not None:
                        done.append((node, digest.hexdigest()))
                    node, digest = at, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            if done:
                yield record({"node": pa.array([n for n, _ in done], pa.int64()), "ends_sha256": pa.array([d for _, d in done])})
                done = []
        if digest is not None:
            yield record({"node": pa.array([node], pa.int64()), "ends_sha256": pa.array([digest.hexdigest()])})

    order = ["node", "conv_id"]
    runs = ends.select("node", F.col("conv_id").cast("long")).repartitionByRange(*order).sortWithinPartitions(*order)
    runs = runs.mapInArrow(strings, "node bigint, first bigint, ids string")
    return runs.repartition("node").sortWithinPartitions("node", "first").select("node", "ids").mapInArrow(hashed, "node bigint, ends_sha256 string")


def prefix_nodes(conversations: DataFrame) -> DataFrame:
    """`conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256` of every node."""
    nodes, ends = trie(*rebuilt(conversations))
    nothing = hashlib.sha256().hexdigest()
    rows = nodes.join(stored(folded(nodes), "trie-folded"), "node").join(stored(end_digests(ends), "trie-digests"), "node", "left")
    return rows.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
