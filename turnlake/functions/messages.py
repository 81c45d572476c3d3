"""Message roles, in-row conversation arrays and battle outcomes.

Arguments are column names; the lambda-heavy expressions are written as SQL text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnlake.functions.text import literal, sha256, strip_sql

USER_ROLES = ("human", "user")
ASSISTANT_ROLES = ("gpt", "assistant", "bot")


def side_sql(role: str) -> str:
    """`user`, `assistant` or NULL."""
    users, assistants = (", ".join(map(literal, names)) for names in (USER_ROLES, ASSISTANT_ROLES))
    name = f"lower({strip_sql(role)})"
    return f"CASE WHEN {name} IN ({users}) THEN 'user' WHEN {name} IN ({assistants}) THEN 'assistant' END"


def body_sql(text: str) -> str:
    return strip_sql(f"coalesce({text}, '')")


def clean_messages(messages: str, role: str, text: str) -> Column:
    """An in-row conversation as array<struct<side, body>>; NULL becomes the empty array."""
    cleaned = f"named_struct('side', {side_sql(f'm.`{role}`')}, 'body', {body_sql(f'm.`{text}`')})"
    empty = "cast(array() AS array<struct<side: string, body: string>>)"
    return F.expr(f"coalesce(transform({messages}, m -> {cleaned}), {empty})")


def turn_pairs(messages: str) -> Column:
    """Each non-blank user message directly followed by an assistant message, in order."""
    pairs = f"greatest(size({messages}) - 1, 0)"
    return F.expr(f"""
        filter(
          zip_with(
            slice({messages}, 1, {pairs}), slice({messages}, 2, {pairs}),
            (a, b) -> named_struct('side', a.side, 'next_side', b.side, 'prompt_text', a.body, 'response_text', b.body)),
          p -> p.side = 'user' AND p.next_side = 'assistant' AND p.prompt_text <> '')""")


def first_user_text(messages: str) -> Column:
    """First non-blank user message, else NULL."""
    return F.expr(f"get(filter({messages}, m -> m.side = 'user' AND m.body <> ''), 0).body")


def assistant_text(messages: str) -> Column:
    """Non-blank assistant messages joined by a blank line."""
    hits = f"filter({messages}, m -> m.side = 'assistant' AND m.body <> '')"
    return F.expr(f"array_join(transform({hits}, m -> m.body), '\\n\\n')")


def content_id(dataset: str, payload: Column, missing: str) -> Column:
    """sha256 of `dataset:` and the payload as compact JSON with sorted keys and explicit nulls."""
    as_json = F.coalesce(F.to_json(payload, {"ignoreNullFields": "false"}), F.lit(missing))
    return sha256(F.concat(F.lit(f"{dataset}:"), as_json))


def outcome(winner: str) -> Column:
    """struct<label_a, label_b, score_a, score_b> of a battle."""

    def row(label_a: str, label_b: str, score_a: str, score_b: str) -> str:
        scores = f"'score_a', cast({score_a} AS double), 'score_b', cast({score_b} AS double)"
        return f"named_struct('label_a', {literal(label_a)}, 'label_b', {literal(label_b)}, {scores})"

    name = f"lower({body_sql(winner)})"
    return F.expr(f"""
        CASE WHEN {name} = 'model_a' THEN {row('winner', 'loser', '1', '0')}
             WHEN {name} = 'model_b' THEN {row('loser', 'winner', '0', '1')}
             WHEN {name} IN ('tie', 'draw') THEN {row('tie', 'tie', '0.5', '0.5')}
             WHEN contains(replace({name}, ' ', ''), 'bothbad') THEN {row('both_bad', 'both_bad', '0', '0')}
             ELSE {row('unknown', 'unknown', 'NULL', 'NULL')} END""")


def winner_model(winner: str, model_a: str, model_b: str) -> Column:
    """Model name of the winning side; NULL for ties and unknown outcomes."""
    return F.expr(f"CASE lower({winner}) WHEN 'model_a' THEN {model_a} WHEN 'model_b' THEN {model_b} END")
