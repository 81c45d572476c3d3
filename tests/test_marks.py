"""The one pass over marks finds what the separate patterns of the features and task rules find."""

import random
import re

import pytest
from pyspark.sql import functions as F

from turnlake.functions import tasks, text
from turnlake.operators.features import prompt_records
from turnlake import schemas

COUNTED = {
    "examples": (r"(?iU)(?:\bexamples?\b|e\.g\.)", text.EXAMPLES),
    "constraints": (r"(?iU)\b(?:step by step|must|should|only|do not)\b", text.CONSTRAINTS),
    "verbs": (r"(?iU)\b(?:create|generate|fix|write|improve|explain|optimize|convert)\b", text.VERBS),
    "roleplay": (r"(?iU)\bact as\b", (text.ROLEPLAY,)),
}
CODE = ((r"(?iU)\bsql\b", "database"), (r"(?iU)\bdebug\b", "debugging"), (r"(?iU)\b(write|generate)\s+code\b", "code_generation"), (r"(?iU)\bexplain\b", "explanation"))
GENERIC = ((r"(?iU)\bdebug|fix\b", "debugging"), (r"(?iU)\b(write|generate|create)\b", "code_generation"), (r"(?iU)\bexplain\b", "explanation"), (r"(?iU)\bsql\b", "database"))
PIECES = (
    "example examples e.g. step by step must should only do not create generate fix write improve explain optimize convert act as sql debug code"
    " prefix fixing debugger e g . , ( ) - _ 1 é ß ſ ı İ i̇ K Σ ñ 中 ́ ‍ \xa0 \t \n x s"
).split(" ") + ["step by step", "do not", "act as", "", "　"]


def first(rules):
    chain = F.when(F.col("t").rlike(rules[0][0]), rules[0][1])
    for pattern, label in rules[1:]:
        chain = chain.when(F.col("t").rlike(pattern), label)
    return chain.otherwise("unknown")


def test_marks_equal_separate_patterns(spark):
    draw = random.Random(7)

    def piece():
        word = draw.choice(PIECES)
        word = draw.choice((str, str, str.upper, str.title))(word)
        return word.replace("s", "ſ") if draw.random() < 0.03 else word.replace("i", draw.choice("ıİ")) if draw.random() < 0.03 else word

    texts = ["".join(piece() + draw.choice(("", " ", " ", "  ", ".", "\n")) for _ in range(draw.randint(0, 12))) for _ in range(20_000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("found", text.marks(F.col("t")))
    wanted = [F.regexp_count("t", F.lit(pattern)).alias(f"old_{name}") for name, (pattern, _) in COUNTED.items()]
    made = [text.count_marks(F.col("found"), words).alias(name) for name, (_, words) in COUNTED.items()]
    rules = [first(CODE).alias("old_code"), tasks.code_task(F.col("t")).alias("code")]
    rules += [first(GENERIC).alias("old_generic"), tasks.task_type(F.lit(None).cast("string"), F.col("t")).alias("generic")]
    rows = df.select("t", *wanted, *made, *rules).collect()
    for name in (*COUNTED, "code", "generic"):
        assert len({row[name] for row in rows}) > 1
        assert [row["t"] for row in rows if row[name] != row[f"old_{name}"]] == []


def test_normalize_equals_one_pattern_for_all_texts(spark):
    draw = random.Random(8)
    blanks = (" ", " ", "  ", "\n", "\t", "\x1f", "\xa0", "　", "\x85", " \n ")
    texts = ["".join(draw.choice((*blanks, "a", "bc", ".", "\x00") + (("é",) if i % 2 else ())) for _ in range(draw.randint(0, 9))) for i in range(4000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", text.normalize(F.col("t")).alias("one"), F.expr(text.normalize_sql("t")).alias("two")).collect()
    for row in rows:
        assert row["one"] == row["two"] == re.sub(r"[\s\x1c-\x1f]+", " ", row["t"]).strip(" ")


def test_odd_letters_are_all_that_patterns_take_for_ascii_ones(spark):
    letters = "|".join("abcdefghijklmnopqrstuvwxyz")
    points = spark.range(128, 0x10000).where("id NOT BETWEEN 55296 AND 57343")
    found = points.select(F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')").alias("c")).where(F.col("c").rlike(f"(?iU)^(?:{letters})$"))
    assert {row["c"] for row in found.collect()} == {"ſ", "ı", "İ", "K"}  # the last one is k in lower case


@pytest.mark.parametrize("label", [None, "english"])
def test_a_prompt_is_searched_by_few_patterns(spark, label):
    rows = spark.createDataFrame([("write it", label)], "prompt_text string, language string")
    plan = prompt_records(schemas.conform(rows, schemas.PROMPT_EVENT))._jdf.queryExecution().optimizedPlan().toString()
    searches = len(re.findall(r"regexp_extract_all\(|RLIKE\(prompt_text", plan))
    assert searches <= 4  # marks (two forms), fence labels, code blocks; 10 before
