import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from turnlake.llm import prefix_trie as op

ROWS = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Every prefix as a tuple of turns."""
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append(((t is not None, t or 0), (r or "", x or "")))
    own = {c: [turn for _, turn in sorted(v, key=lambda y: y[0])] for c, v in own.items()}
    made = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = tuple(own.get(c - c % 5, [])[:h] + v[h:])
    members, ends, children = {}, {}, {}
    for c, v in made.items():
        ends.setdefault(v, []).append(c)
        for d in range(len(v) + 1):
            members.setdefault(v[:d], []).append(c)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    out = {}
    for node in sorted(members, key=len, reverse=True):
        below = [out[x] for x in children.get(node, [])]
        saved = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0) + sum(x[6] for x in below)
        ids = ",".join(map(str, sorted(ends.get(node, []))))
        out[node] = (
            min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(below),
            sum(x[5] for x in below) or 1, saved, hashlib.sha256(ids.encode()).hexdigest(),
        )
    return sorted(out.values(), key=str)


def check(spark, rows):
    df = spark.createDataFrame(rows, ROWS).withColumn("node", F.lit("x")).withColumn("size", F.lit(1))
    assert sorted((tuple(r) for r in op.prefix_nodes(df).collect()), key=str) == brute(rows)


def some(seed, convs, deepest):
    pick, rows = random.Random(seed), []
    for c in range(convs):
        for t in range(pick.randrange(1, deepest)):
            rows.append((c, t, pick.choice(["user", "assistant", None, ""]), pick.choice(["a", "b", "é", "", None, f"own {c}"])))
    return rows


def test_equals_brute_force(spark):
    rows = some(1, 60, 12)
    random.Random(2).shuffle(rows)
    check(spark, rows)


def test_gaps_null_turns_and_absent_leaders(spark):
    rows = [(c, t * 10 if t else None, "user", f"{t % 3}") for c in (1, 2, 3, 7, 8, 10, 11, 23) for t in range(c % 4 + 1)]
    check(spark, [*rows, (None, 0, "user", "no conversation"), (None, 1, None, None)])


def test_one_long_conversation_and_many_equal_ones(spark):
    rows = [(0, t, "user", f"{t}") for t in range(2000)]
    rows += [(c, t, "user", "same") for c in range(1000, 1600) for t in range(2)]
    check(spark, rows)


def test_empty_and_single(spark):
    assert op.prefix_nodes(spark.createDataFrame([], ROWS)).count() == 0
    check(spark, [(4, 0, "user", "x")])


@pytest.mark.parametrize("size", [1, 2, 50, 700])
def test_list_ranks(spark, size):
    order = list(range(size))
    random.Random(size).shuffle(order)
    rows = [(x, order[i + 1] if i + 1 < size else None, order[i - 1] if i else None) for i, x in enumerate(order)]
    arcs = spark.createDataFrame(rows, "id long, next long, prev long")
    found = {r["id"]: r["rank"] for r in op.list_ranks(arcs, finish=20).collect()}
    assert found == {x: i for i, x in enumerate(order)}


def test_ids_are_hashed_in_pieces(spark):
    ends = spark.createDataFrame([(n, c) for n in (1, 2) for c in range(0, 500, n)], "node long, conv_id long")
    found = {r[0]: r[1] for r in op.end_digests(ends, chunk=50).collect()}
    assert found == {n: hashlib.sha256(",".join(map(str, range(0, 500, n))).encode()).hexdigest() for n in (1, 2)}
