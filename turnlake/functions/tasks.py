"""Task labels from text and the label slug."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnlake.functions.text import marks, strip

# The first rule with one of its marks (see `text.MARKS`) wins.
CODE_GENERATION = r"(?iU)\b(write|generate)\s+code\b"
CODE_TASKS = (
    (("sql",), "database"),
    (("debug",), "debugging"),
    (("writ", "generat"), "code_generation"),  # followed by "code"
    (("explain",), "explanation"),
)
# The first rule reads as (\bdebug) or (fix\b): "prefix" matches, "fixing" does not.
GENERIC_TASKS = (
    (("debug", "debu", "fix", "fi"), "debugging"),
    (("writ", "generat", "creat"), "code_generation"),
    (("explain",), "explanation"),
    (("sql",), "database"),
)


def _first_match(found: Column, rules: tuple[tuple[tuple[str, ...], str], ...], also: dict[str, Column] | None = None) -> Column:
    def holds(words: tuple[str, ...], label: str) -> Column:
        held = F.arrays_overlap(found, F.array(*map(F.lit, words)))
        return held & also[label] if also and label in also else held

    (words, label), *rest = rules
    chain = F.when(holds(words, label), label)
    return reduce(lambda c, rule: c.when(holds(*rule), rule[1]), rest, chain).otherwise("unknown")


def code_task(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    also = {"code_generation": text.rlike(CODE_GENERATION)}
    return F.get(F.transform(F.array(marks(text)), lambda found: _first_match(found, CODE_TASKS, also)), F.lit(0))


def slug(label: Column) -> Column:
    """Lower case, every run of other characters to `_`, `unknown` when nothing is left."""
    lowered = F.lower(strip(label.cast("string")))
    underscored = F.trim(F.regexp_replace(lowered, "[^a-z0-9]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(underscored, F.lit("")), F.lit("unknown"))


def task_type(label: Column, text: Column, found: Column | None = None) -> Column:
    """A usable label wins; otherwise the generic rules decide, on the text's marks (`found`, if they are at hand)."""
    given = F.lower(strip(label))
    found = F.array(marks(text) if found is None else found)
    ruled = F.get(F.transform(found, lambda words: _first_match(words, GENERIC_TASKS)), F.lit(0))
    return F.when((given != "") & (given != "unknown"), slug(given)).otherwise(ruled)
