"""Turn operators on flat message tables: (conversation_id, turn, role, text), turn counted from 0.

(conversation_id, turn) is unique. Which messages belong together is found on narrow rows without text: they are laid out in
the order of conversation and turn over range partitions, which are scanned once each (see `scan`). A conversation with a
third of all rows, or with gaps between its turns, is spread like any other, and there is one plan for all. Texts then join
by (conversation_id, turn), a key that no two rows share.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlake.functions.messages import body_sql, side_sql
from turnlake.operators import scan

PLACE = ["conversation_id", "turn"]


def _messages(messages: DataFrame) -> DataFrame:
    return messages.selectExpr(
        "conversation_id", "turn", f"{side_sql('role')} AS side", f"{body_sql('text')} AS body"
    )


def _with_text(rows: DataFrame, texts: DataFrame, turn: str = "turn") -> DataFrame:
    """The rows with the columns of the messages at (conversation_id, `turn`)."""
    named = texts.withColumnsRenamed({name: f"_{name}" for name in PLACE})
    same = [F.col("conversation_id").eqNullSafe(F.col("_conversation_id")), F.col(turn).eqNullSafe(F.col("_turn"))]
    return rows.join(named, reduce(Column.__and__, same)).drop("_conversation_id", "_turn")


def turn_pairs(messages: DataFrame) -> DataFrame:
    """Non-blank user messages directly followed by an assistant message, numbered from 1 per conversation."""
    texts = _messages(messages)
    rows = scan.laid(texts.select(*PLACE, "side", (F.col("body") != "").alias("filled")), PLACE, "turns")
    asked = (F.col("side") == "user") & F.col("filled")
    answered = F.col("next_conversation_id").eqNullSafe(F.col("conversation_id")) & (F.col("next_side") == "assistant")
    pair = F.coalesce(asked & answered, F.lit(False)).cast("int")
    numbered = scan.walked(rows, "conversation_id", [*PLACE, "side"], {"pair": pair}).where("pair = 1")
    numbered = numbered.select(*PLACE, "next_turn", "running_pair")
    prompts = texts.where((F.col("side") == "user") & (F.col("body") != "")).select(*PLACE, F.col("body").alias("prompt_text"))
    replies = texts.where(F.col("side") == "assistant").select(*PLACE, F.nullif(F.col("body"), F.lit("")).alias("response_text"))
    return _with_text(_with_text(numbered, prompts), replies, "next_turn").select(
        "conversation_id", F.col("running_pair").cast("int").alias("turn_number"), "prompt_text", "response_text"
    )


def first_user_message(messages: DataFrame) -> DataFrame:
    """First non-blank user message per conversation: its turn is a minimum of numbers, its text joins by that turn."""
    users = _messages(messages).where((F.col("side") == "user") & (F.col("body") != "")).select(*PLACE, F.col("body").alias("prompt_text"))
    first = users.groupBy("conversation_id").agg(F.min("turn").alias("turn"))
    return _with_text(first, users).select("conversation_id", "prompt_text")


def assistant_transcript(messages: DataFrame) -> DataFrame:
    """The assistant transcript of each conversation as ordered parts.

    Joining the parts of a conversation with a blank line in the order of `part` gives the whole transcript;
    `char_offset` is the place of the part in it. The parts stay separate rows because a flat conversation
    has no size limit and must not be collected into one value.
    """
    texts = _messages(messages).where((F.col("side") == "assistant") & (F.col("body") != "")).drop("side")
    rows = scan.laid(texts.select(*PLACE, F.lit(1).alias("n"), (F.length("body") + 2).alias("chars")), PLACE, "transcript")
    placed = scan.running_within(rows, "conversation_id", ["n", "chars"])
    return _with_text(placed, texts).select(
        "conversation_id",
        F.col("running_n").cast("int").alias("part"),
        (F.col("running_chars") - F.col("chars")).alias("char_offset"),
        F.col("body").alias("response_text"),
    )
