"""Licence scan: Dice coefficient over word bigrams between windows of a text and licence templates.

Texts are normalised to lower-case ASCII words. A window is any run of a text's word pairs, wherever lines break; its
Dice coefficient with a template is twice the number of the template's distinct pairs in it over the sum of both sizes (the
window's pairs, repeats included, and the template's distinct ones). A coefficient of `LEAST` bounds the ratio of the sizes,
so windows of a template are at most `span` pairs long, and the best window begins and ends with a pair of the template.

A window that is like a template has two thirds of its pairs (for 0.8), so texts are screened first by the words of enough
pairs, which loses nothing (see `screen_sql`). What is left is exploded into pairs and joined with the templates, a stated set; templates of which a text has too few pairs go. Each remaining pair then
meets the starts at most `span` before it (binned by `span`), and a running sum of the pairs that are new since a start gives
the coefficients of all its windows. A text's own windows are bounded by its length times the templates' sizes.

Null texts have no windows. Rows with the same id and text all get the result. Only `doc_id` and `text` are read. An
empty table gives no rows. No Python runs on the executors.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from turnlake.session import stored

LEAST = 0.8
COMMON = frozenset("the of and to in is it for by on or as at be an a if no not was you may any all can one this".split())

# The usual notices of public licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)


def _normal(text: Column) -> Column:
    """Lower-case ASCII letters and digits; every other run becomes one space."""
    return F.lower(F.regexp_replace(text, "[^A-Za-z0-9]+", " "))


def _words(normal: Column) -> Column:
    return F.filter(F.split(normal, " "), lambda w: w != "")


def _neighbours(words: Column) -> Column:
    return F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.concat(a, F.lit(" "), b))


def templates(spark: SparkSession, texts=TEMPLATES) -> DataFrame:
    """`template, license, m, pair`: the template's number, its number of pairs, and each of them."""
    rows = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(texts)], "template int, license string, text string")
    rows = rows.withColumn("pairs", F.array_distinct(_neighbours(_words(_normal(F.col("text"))))))
    return rows.select("template", "license", F.size("pairs").alias("m"), F.explode("pairs").alias("pair"))


def _named(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.hex(F.xxhash64(text)), F.length(text))
    return docs.select(name.alias("row"), "doc_id", text.alias("text"))


def _plain_words(text: str) -> list[str]:
    return re.sub("[^A-Za-z0-9]+", " ", text).lower().split()


def _distinct_pairs(text: str) -> set[tuple[str, str]]:
    words = _plain_words(text)
    return set(zip(words, words[1:], strict=False))


def _balanced(parts: list[str], operator: str) -> str:
    """The parts under one operator, nested by halves: a long chain would be too deep to parse."""
    if len(parts) < 2:
        return "".join(parts)
    half = len(parts) // 2
    return f"({_balanced(parts[:half], operator)} {operator} {_balanced(parts[half:], operator)})"


def screen_sql(texts=TEMPLATES, least: float = LEAST) -> str:
    """SQL that holds for every text with a window like a template; most others fail it.

    A window lacks less than a third (for 0.8) of a template's pairs, so the text has both words of the others. First any
    of a few words that are in more pairs than may be missing, the longest ones; then, per template, enough pairs whose
    words are there. Common short words are taken to be in every text; other short ones must stand alone.
    """
    ratio, chosen, tests = least / (2 - least), set(), []
    tested = sorted({w for _, t in texts for w in _plain_words(t) if len(w) > 3 or w not in COMMON})

    def there(word: str) -> str:
        return f"contains(t, '{word}')" if len(word) > 3 else f"t RLIKE '(?<![a-z0-9]){word}(?![a-z0-9])'"

    for _, text in texts:
        pairs = _distinct_pairs(text)
        for word in sorted({w for pair in pairs for w in pair} & set(tested), key=lambda w: (-len(w), w)):
            if sum(x in chosen or y in chosen for x, y in pairs) > (1 - ratio) * len(pairs) + 1e-9:
                break
            chosen.add(word)
        known = [sorted(tested.index(w) for w in set(pair) & set(tested)) for pair in sorted(pairs)]
        both = _balanced([f"IF({' AND '.join(f'p[{i}]' for i in places) or 'true'}, 1, 0)" for places in known], "+") or "0"
        tests.append(f"{both} >= {ratio * len(pairs) - 1e-9}")
    if any(sum(x in chosen or y in chosen for x, y in _distinct_pairs(t)) <= (1 - ratio) * len(_distinct_pairs(t)) + 1e-9 for _, t in texts):
        chosen = set()  # a template of common words only: no first test
    first = _balanced(list(map(there, sorted(chosen))), "OR") or "true"
    enough = f"get(transform(array(array({', '.join(map(there, tested))})), p -> {_balanced(tests, 'OR')}), 0)" if texts else "false"
    return f"get(transform(array(lower(text)), t -> {first} AND {enough}), 0)"


def occurrences(docs: DataFrame, known: DataFrame, texts=TEMPLATES, least: float = LEAST) -> DataFrame:
    """`row, template, license, m, pair, at`: where the templates' pairs occur in texts that pass the screen."""
    near = _named(docs).where(F.expr(screen_sql(texts, least)))
    words = near.select("row", _words(_normal(F.col("text"))).alias("words")).where(F.size("words") > 1)
    found = words.select("row", F.posexplode(_neighbours(F.col("words"))).alias("at", "pair")).join(F.broadcast(known), "pair")
    return found.distinct()  # rows of equal id and text


def matches(docs: DataFrame, texts=TEMPLATES, least: float = LEAST) -> DataFrame:
    """`row, template, license, start, n, dice` of all windows that are like a template, of every text once."""
    known = stored(templates(docs.sparkSession, texts), "licence-pairs")
    ratio = least / (2 - least)  # of the smaller size to the larger one, at least
    found = stored(occurrences(docs, known, texts, least), "licence-places")
    enough = found.groupBy("row", "template").agg(F.countDistinct("pair").alias("both"), F.max("m").alias("m")).where(F.col("both") >= F.lit(ratio) * F.col("m"))
    found = found.join(enough.select("row", "template"), ["row", "template"], "left_semi")
    before = W.partitionBy("row", "template", "pair").orderBy("at")
    span = F.floor(F.col("m") / ratio + 1e-9)
    found = found.select("row", "template", "license", "m", "at", F.lag("at").over(before).alias("last"), span.alias("span"), F.floor(F.col("at") / span).alias("bin"))
    starts = found.select("row", "template", F.col("at").alias("start"), F.explode(F.array("bin", F.col("bin") + 1)).alias("bin"))
    met = found.join(starts, ["row", "template", "bin"]).where((F.col("start") <= F.col("at")) & (F.col("at") < F.col("start") + F.col("span")))
    new = (F.col("last").isNull() | (F.col("last") < F.col("start"))).cast("long")
    upto = W.partitionBy("row", "template", "start").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    n = F.col("at") - F.col("start") + 1
    dice = 2 * F.sum(new).over(upto) / (n + F.col("m"))
    return met.select("row", "template", "license", "start", n.alias("n"), dice.alias("dice")).where(F.col("dice") >= least)


def scanned(docs: DataFrame, texts=TEMPLATES, least: float = LEAST) -> DataFrame:
    """`doc_id, n_licenses, licenses, best_license, best_dice` for every row; without a match null, and no licences.

    `n_licenses` counts the licences that a window is like, `licenses` are their names in order, the best one has the
    greatest coefficient (the first name among equals).
    """
    found = matches(docs, texts, least).groupBy("row", "license").agg(F.max("dice").alias("dice")).groupBy("row").agg(
        F.count(F.lit(1)).alias("n_licenses"), F.array_join(F.sort_array(F.collect_set("license")), ",").alias("licenses"),
        F.min(F.struct((-F.col("dice")).alias("dice"), "license")).alias("best"),
    )
    return _named(docs).select("row", "doc_id").join(found, "row", "left").select(
        "doc_id", F.coalesce("n_licenses", F.lit(0)).alias("n_licenses"), F.coalesce("licenses", F.lit("")).alias("licenses"),
        F.col("best.license").alias("best_license"), (-F.col("best.dice")).alias("best_dice"),
    )
