import random

import pytest
from conftest import values

from turnlake.operators import turns

SIDES = {"user": "user", "Human": "user", "assistant": "assistant", "gpt": "assistant", "system": None}


@pytest.fixture
def partitions(spark):
    """Sets the number of range partitions, small ones included, for one test."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {name: spark.conf.get(name) for name in names}

    def use(n):
        spark.conf.set(names[0], n)
        spark.conf.set(names[1], False)

    yield use
    for name, value in before.items():
        spark.conf.set(name, value)


def messages(seed=3, conversations=6, hot=200):
    """One conversation holds most of the rows; turn numbers have gaps."""
    rng, rows = random.Random(seed), []
    for c in range(conversations):
        turn = 0
        for _ in range(hot if c == 0 else rng.randint(1, 9)):
            rows.append((f"c{c}", turn, rng.choice(list(SIDES)), rng.choice(["", " ", "a", "bb", " ccc "])))
            turn += rng.choice([1, 1, 1, 2, 7])
    return rows


def brute_pairs(rows):
    out = []
    for c in {r[0] for r in rows}:
        talk, n = sorted(r for r in rows if r[0] == c), 0
        for a, b in zip(talk, talk[1:]):
            if SIDES[a[2]] == "user" and SIDES[b[2]] == "assistant" and a[3].strip():
                n += 1
                out.append((c, n, a[3].strip(), b[3].strip() or None))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_flat_pairs_at_any_number_of_partitions(spark, parts, partitions):
    partitions(parts)
    rows = messages()
    df = spark.createDataFrame(rows, "conversation_id string, turn long, role string, text string").repartition(5)
    assert values(turns.turn_pairs(df)) == brute_pairs(rows)


@pytest.mark.parametrize("parts", [1, 7])
def test_transcript_parts_join_to_the_transcript(spark, parts, partitions):
    partitions(parts)
    rows = messages(seed=5)
    df = spark.createDataFrame(rows, "conversation_id string, turn long, role string, text string")
    parts = turns.assistant_transcript(df).collect()
    for c in {r[0] for r in rows}:
        whole = "\n\n".join(r[3].strip() for r in sorted(rows) if r[0] == c and SIDES[r[2]] == "assistant" and r[3].strip())
        mine = sorted((p["part"], p["char_offset"], p["response_text"]) for p in parts if p["conversation_id"] == c)
        assert "\n\n".join(p[2] for p in mine) == whole
        assert [p[0] for p in mine] == list(range(1, len(mine) + 1))
        assert all(whole[at : at + len(body)] == body for _, at, body in mine)


def test_first_user_message(spark):
    rows = messages(seed=8)
    df = spark.createDataFrame(rows, "conversation_id string, turn long, role string, text string")
    expected = {}
    for c, _, role, body in sorted(rows):
        if SIDES[role] == "user" and body.strip():
            expected.setdefault(c, body.strip())
    assert dict(values(turns.first_user_message(df))) == expected


def test_sparse_turns_and_no_window_over_a_conversation(spark, partitions):
    """A third of the rows in one conversation, turns up to a billion, ids that are missing."""
    partitions(8)
    rng, rows = random.Random(11), []
    for c in (None, *range(40)):
        turns_ = rng.sample(range(10**9), 300 if c == 3 else rng.randint(1, 30))
        rows += [(c if c is None else f"c{c}", t, rng.choice(list(SIDES)), rng.choice(["", "a", f"text {t}"])) for t in turns_]
    df = spark.createDataFrame(rows, "conversation_id string, turn long, role string, text string")
    found = turns.turn_pairs(df)
    by_name = [(r[0] or "", *r[1:]) for r in rows]
    expected = [(c or None, *rest) for c, *rest in brute_pairs(by_name)]
    assert values(found) == sorted(expected, key=lambda r: tuple((v is None, str(v)) for v in r))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition(" in line]
    assert windows and all("windowspecdefinition(part#" in line or "windowspecdefinition(last_key#" in line for line in windows)
