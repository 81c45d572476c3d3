"""Language detection by character trigrams: a naive-Bayes profile that is fitted on labelled texts and stored as a table.

A text's features are the trigrams of its distinct words (letters only, with a blank at both ends, up to `LONGEST` letters;
longer runs of letters are no words). A trigram is a bucket of its three code points, so a profile is one whole number per
language and bucket, and scoring is sums over array look-ups in the row: no join, no shuffle. Scripts that name their language
by themselves come first, as they have no labelled texts here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlake.functions.text import by_script_sql, literal, normalize_sql
from turnlake.session import stored

BUCKETS = 8191
LONGEST = 40
MOST_LANGUAGES = 64  # of a profile: it is held as arrays of BUCKETS numbers
MIX = (7919, 131, 1)
UNSEEN = -1  # the bucket of what a language has not shown


def words_sql(text: str) -> str:
    """SQL for the distinct words of a text."""
    return rf"filter(array_distinct(split(lower(coalesce({text}, '')), '[^\\p{{L}}]+')), w -> length(w) BETWEEN 1 AND {LONGEST})"


def word_trigrams_sql(word: str) -> str:
    """SQL for the buckets of a word's trigrams. A character's code point is taken once, not once for each trigram."""
    points = f"transform(split(concat(' ', {word}, ' '), ''), c -> ascii(c))"
    bucket = " + ".join(f"get(p, i + {k}) * {factor}L" for k, factor in enumerate(MIX))
    return f"get(transform(array({points}), p -> transform(sequence(0, size(p) - 3), i -> cast(({bucket}) % {BUCKETS} AS int))), 0)"


def trigrams_sql(text: str) -> str:
    """SQL for the buckets of a text's trigrams."""
    return f"flatten(transform({words_sql(text)}, w -> {word_trigrams_sql('w')}))"


def fitted(texts: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The profile of labelled texts: `lang, bucket, weight`, the log-probability in thousandths.

    Texts are counted by word first, so a word's trigrams are made once for a language, not once for a text. The second
    aggregation is combined map-side to languages x buckets; buckets that a language has not shown share one row.
    """
    words = texts.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.explode(F.expr(words_sql(f"`{text}`"))).alias("word"))
    known = words.groupBy("lang", "word").agg(F.count("*").alias("n"))
    seen = known.select("lang", "n", F.explode(F.expr(word_trigrams_sql("word"))).alias("bucket"))
    counts = stored(seen.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-counts")
    totals = counts.groupBy("lang").agg((F.sum("n") + 0.5 * BUCKETS).alias("total"))

    def weight(n: Column) -> Column:
        return F.round(1000 * F.log((n + 0.5) / F.col("total"))).cast("bigint").alias("weight")

    rare = totals.select("lang", F.lit(UNSEEN).alias("bucket"), weight(F.lit(0)))
    return stored(counts.join(totals, "lang").select("lang", "bucket", weight(F.col("n"))).unionByName(rare), "language-profile")


@dataclass(frozen=True)
class Profile:
    """Weights per language, in the order of the codes."""

    weights: dict[str, list[int]]

    @classmethod
    def read(cls, table: DataFrame) -> Profile:
        """A stored profile table: at most MOST_LANGUAGES x BUCKETS rows reach the driver."""
        rows = table.limit(MOST_LANGUAGES * (BUCKETS + 1) + 1).collect()
        by_lang: dict[str, dict[int, int]] = {}
        for row in rows:
            by_lang.setdefault(row["lang"], {})[row["bucket"]] = row["weight"]
        if len(by_lang) > MOST_LANGUAGES:
            raise ValueError(f"a profile has at most {MOST_LANGUAGES} languages")
        return cls({code: [found.get(b, found[UNSEEN]) for b in range(BUCKETS)] for code, found in sorted(by_lang.items())})

    def detected_sql(self, text: str) -> str:
        """SQL for the language of a text: by script, else the highest sum of weights (ties by code), else `unknown`."""
        if not self.weights:
            return f"coalesce({by_script_sql(normalize_sql(text))}, 'unknown')"
        scores = ", ".join(
            f"named_struct('score', aggregate(grams, 0L, (acc, g) -> acc + get(cast(split('{','.join(map(str, w))}', ',') AS array<bigint>), g)), 'code', {literal(code)})"
            for code, w in self.weights.items()
        )
        best = f"reduce(array({scores}), cast(NULL AS struct<score: bigint, code: string>), (top, one) -> CASE WHEN top IS NULL OR one.score > top.score THEN one ELSE top END).code"
        by_grams = f"get(transform(array({trigrams_sql(text)}), grams -> CASE WHEN size(grams) > 0 THEN {best} ELSE 'unknown' END), 0)"
        return f"coalesce({by_script_sql(normalize_sql(text))}, {by_grams})"

    def detected(self, text: str) -> Column:
        return F.expr(self.detected_sql(text))
