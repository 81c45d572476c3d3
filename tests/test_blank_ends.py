"""Blanks at the ends of texts and control characters: what the cheaper forms leave out changes no result."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from turnlake.functions import text as X

# Letters whose last byte is, or is not, one that a blank ends with.
LETTERS = ("a", "é", "à", "؀", "、", "​", "\U0001f600", "가", "\x00")


def test_strip_and_normalize_take_every_blank_and_no_letter(spark):
    ends = [*X.BLANKS, *LETTERS]
    texts = ["", None, *(a + b + "x" + b + "y" + a for a, b in product(ends, ends)), *map("".join, product(ends, ends))]
    df = spark.createDataFrame([(text,) for text in texts], "t string")
    got = df.select("t", X.strip(F.col("t")).alias("a"), F.expr(X.strip_sql("t")).alias("b"), X.normalize(F.col("t")).alias("n")).collect()
    for row in got:
        assert row["a"] == row["b"] == (None if row["t"] is None else row["t"].strip(X.BLANKS))
        blank = "".join(" " if c in X.BLANKS else c for c in row["t"] or "")
        assert row["n"] == " ".join(part for part in blank.split(" ") if part)


def test_texts_without_blank_ends_or_control_characters_are_spared(spark):
    df = spark.createDataFrame([("a\x00b\r\nc\rd\n",), ("plain\n",), (None,)], "t string")
    rows = df.select(X.clean_payload(F.col("t")).alias("c"))
    assert [r["c"] for r in rows.collect()] == ["ab\nc\nd\n", "plain\n", None]
    for made in (rows, df.select(X.strip(F.col("t"))), df.select(F.expr(X.strip_sql("t")))):
        assert "CASE WHEN" in made._jdf.queryExecution().optimizedPlan().toString()
