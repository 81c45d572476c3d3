"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document's grade is 0 if it is rated toxic, 1 if it is rated of low quality only, and 2 if it is rated good. One weight
vector over hashed text features is shared by all grades, and ordered thresholds divide its score:
P(grade <= k) = sigmoid(threshold_k - score). A document is selected if the probability of the highest grade is at least
`SELECT`.

Features are the document's distinct words (lower-cased, hashed to `BUCKETS`) and a few shares: capitals, characters that
are no letters, words with a run of marks, distinct words. An L1 penalty leaves weight only on words that matter, so long
documents of many rare words don't drift.

The model is fitted on at most `SAMPLE` labelled documents (a documented bound), chosen by the hash of their id, one row of
each id (of several, the text with the least hash); their features are made in parallel and fitted in one task, in an order
that the ids and texts give, so the rows' places in the table change nothing, not a bit. Scoring reads every whole text where it lies, with the weights
broadcast (`BUCKETS` numbers).

Ratings that are null or whose document is missing or has no text are ignored; several ratings of an id count as their
worst. With fewer than two grades in the sample every document is selected. Null texts count as empty. Repeated rows
give repeated results. Columns of any name may be in the table. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnlake.llm.words import batches, id_type, plain_words, record, schema, text_bytes

BUCKETS = 1 << 18
SHARES = 4
SAMPLE = 20_000
GRADES = 3
SELECT = 0.5
ROUNDS = 200
LEAST = 3  # documents of the sample that a word is in, for a weight
PRICE = 2.0  # documents' worth of evidence that a word needs for a weight: the L1 penalty times the sample's size
L2 = 1e-4
_MARKS = frozenset(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


class Features:
    """Buckets of a text's distinct words and its shares; remembers the buckets of words."""

    HELD = 150_000

    def __init__(self) -> None:
        self.bucket: dict[bytes, int] = {}

    def words(self, text: bytes) -> np.ndarray:
        kinds, known = set(plain_words(text)), self.bucket
        if len(known) > self.HELD:
            known.clear()
        out = []
        for word in kinds:
            at = known.get(word)
            if at is None:
                at = known[word] = xxhash.xxh64_intdigest(word, 7) % BUCKETS
            out.append(at)
        return np.unique(np.array(out, np.int32))

    @staticmethod
    def shares(text: bytes) -> tuple[float, float, float, float]:
        words = text.split()
        n = max(1, len(words))
        capitals = len(text) - len(text.translate(None, bytes(range(0x41, 0x5B))))
        letters = len(text) - len(text.translate(None, bytes([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])))
        marked = sum(1 for w in words if len(w) > 1 and w[-1] in _MARKS and w[-2] in _MARKS or w[-1] in b"|")
        return capitals / max(1, letters), 1 - letters / max(1, len(text)), marked / n, len(set(words)) / n


@dataclass
class Ordinal:
    weights: np.ndarray  # of buckets, then of shares
    thresholds: np.ndarray

    def scores(self, features: Features, texts: list[bytes]) -> np.ndarray:
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            out[i] = self.weights[features.words(text)].sum() + np.dot(self.weights[BUCKETS:], features.shares(text))
        return out

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ... in columns."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -50, 50)))


def distinct_rows(rows: np.ndarray, buckets: np.ndarray, n: int) -> np.ndarray:
    """The first of the rows with the same MinHash signature: copies would count a chance word several times."""
    cuts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1]))) if len(rows) else np.zeros(0, np.int64)
    signature = np.full((n, 4), -1, np.int64)
    for i, factor in enumerate((0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)):
        if len(cuts):
            signature[rows[cuts], i] = np.minimum.reduceat(((buckets.astype(np.uint32) + np.uint32(1)) * np.uint32(factor)).astype(np.int64), cuts)
    return np.sort(np.unique(signature, axis=0, return_index=True)[1])


def cumulative_link(score: np.ndarray, thresholds: np.ndarray, grades: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The mean loss, and its slopes by each row's score and by each threshold."""
    padded, n = np.concatenate(([-50.0], thresholds, [50.0])), len(grades)

    def below(k: np.ndarray) -> np.ndarray:
        """P(grade <= k) for each row's own k."""
        return 1 / (1 + np.exp(np.clip(score - padded[k + 1], -50, 50)))

    high, low = below(grades), below(grades - 1)
    chance = np.maximum(high - low, 1e-9)
    slope_high, slope_low = high * (1 - high) / chance, low * (1 - low) / chance
    by_threshold = np.array([(-slope_high[grades == k].sum() + slope_low[grades == k + 1].sum()) / n for k in range(len(thresholds))])
    return float(-np.log(chance).mean()), (slope_high - slope_low) / n, by_threshold


def _summed(to: np.ndarray, of: np.ndarray, values: np.ndarray, size: int, step: int = 1 << 20) -> np.ndarray:
    """Sums of `values[of]` by `to`, a piece at a time: the list of words present is long, its values need not all be there."""
    out = np.zeros(size)
    for at in range(0, len(to), step):
        out += np.bincount(to[at : at + step], values[of[at : at + step]], size)
    return out


def fit(rows: np.ndarray, buckets: np.ndarray, shares: np.ndarray, grades: np.ndarray) -> Ordinal:
    """Proximal gradient descent with steps scaled by the gradients so far; `rows` and `buckets` list the words present."""
    n = len(grades)
    stay = distinct_rows(rows, buckets, n)
    number = np.full(n, -1, np.int32)
    number[stay] = np.arange(len(stay), dtype=np.int32)
    rows = number[rows]
    known = rows >= 0
    rows, buckets, shares, grades, n = rows[known], buckets[known], shares[stay], grades[stay], len(stay)
    if len(np.unique(grades)) < 2:
        return Ordinal(np.zeros(BUCKETS + SHARES), np.full(GRADES - 1, -50.0))
    counts = np.bincount(buckets, minlength=BUCKETS)
    used = np.flatnonzero(counts >= LEAST)  # rarer words get no weight
    column = np.full(BUCKETS, -1, np.int32)
    column[used] = np.arange(len(used), dtype=np.int32)
    columns = column[buckets]
    known = columns >= 0
    rows, columns, size = rows[known], columns[known], counts[used]
    del buckets, known, column, number
    scale = 1 / np.sqrt(np.maximum(size, 1) / n + 0.01)  # rarer words take larger steps
    spread = shares.std(axis=0) + 1e-6
    dense = shares / spread
    weights, dense_weights = np.zeros(len(used)), np.zeros(SHARES)
    share_below = np.clip([(grades < k).mean() for k in range(1, GRADES)], 1e-3, 1 - 1e-3)
    thresholds = np.sort(np.log(share_below / (1 - share_below)))
    held_back, price = np.ones(len(used)), PRICE / n
    steps = [np.zeros_like(weights), np.zeros_like(dense_weights), np.zeros_like(thresholds)]

    for turn in range(2 * ROUNDS):
        if turn == ROUNDS:  # the chosen words are fitted again without the penalty, which had held their weights down
            held_back, price = (weights != 0).astype(float), 0.0
            steps[0] = np.zeros_like(weights)
        score = _summed(rows, columns, weights, n) + dense @ dense_weights
        _, pull, by_threshold = cumulative_link(score, thresholds, grades)
        gradients = (
            held_back * (_summed(columns, rows, pull, len(used)) + L2 * weights),
            dense.T @ pull,
            by_threshold,
        )
        for held, gradient in zip(steps, gradients, strict=True):
            held += gradient**2
        rates = [0.5 / np.sqrt(held + 1e-8) for held in steps]
        rates[0] = np.minimum(rates[0], 50 * scale)
        weights = weights - rates[0] * gradients[0]
        weights = np.sign(weights) * np.maximum(np.abs(weights) - rates[0] * price, 0)
        dense_weights = dense_weights - rates[1] * gradients[1]
        thresholds = np.sort(thresholds - rates[2] * gradients[2])
    out = np.zeros(BUCKETS + SHARES)
    out[used], out[BUCKETS:] = weights, dense_weights / spread
    return Ordinal(out, thresholds)


def graded(labels: DataFrame) -> DataFrame:
    """`doc_id, grade` of the rated ids, each once."""
    rated = labels.where("doc_id is not null and quality is not null and toxic is not null")
    grade = F.when(F.col("toxic") > 0, 0).when(F.col("quality") < 1, 1).otherwise(2)
    return rated.groupBy("doc_id").agg(F.min(grade).alias("grade"))


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ordinal:
    chosen = graded(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", text_bytes().alias("text")).join(F.broadcast(chosen), "doc_id")  # `sample` ids at most
    texts = texts.withColumn("digest", F.xxhash64("text"))
    least = texts.groupBy("doc_id").agg(F.min("digest").alias("digest"))  # a row per id: `sample` rows at most
    texts = texts.join(F.broadcast(least), ["doc_id", "digest"])
    texts = texts.withColumn("place", F.xxhash64("doc_id", "digest"))

    def featured(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches(stream, 500):
            found = [(features.words(t), features.shares(t)) for t in batch.column(0).to_pylist()]
            yield record({"words": pa.array([w for w, _ in found], pa.list_(pa.int32())), "shares": pa.array([s for _, s in found], pa.list_(pa.float64())), "grade": batch.column(1), "place": batch.column(2)})

    def fitted(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, buckets, shares, grades, n = [], [], [], [], 0
        for batch in stream:
            lists = batch.column(0)
            lengths = np.diff(lists.offsets.to_numpy())
            rows.append(np.repeat(np.arange(n, n + batch.num_rows, dtype=np.int32), lengths))
            buckets.append(lists.flatten().to_numpy())
            shares.append(batch.column(1).flatten().to_numpy().reshape(-1, SHARES))
            grades.append(batch.column(2).to_numpy())
            n += batch.num_rows
        if n:
            parts = [rows, buckets, shares, grades]
            del rows, buckets, shares, grades
            words = [np.concatenate(parts.pop(0)) for _ in range(2)]
            model = fit(words.pop(0), words.pop(0), np.concatenate(parts[0]), np.concatenate(parts[1]).astype(np.int64))
            yield record({"weights": pa.array([model.weights], pa.list_(pa.float64())), "thresholds": pa.array([model.thresholds], pa.list_(pa.float64()))})

    read = texts.select("text", "grade", "place").mapInArrow(featured, "words array<int>, shares array<double>, grade int, place bigint")
    read = read.dropDuplicates(["place"])  # rows that are equal in id and text
    found = read.repartition(1).sortWithinPartitions("place").mapInArrow(fitted, "weights array<double>, thresholds array<double>").first()
    if found is None:
        return Ordinal(np.zeros(BUCKETS + SHARES), np.full(GRADES - 1, -50.0))
    return Ordinal(np.array(found["weights"]), np.array(found["thresholds"]))


def rated(docs: DataFrame, model: Ordinal, select: float = SELECT) -> DataFrame:
    """`doc_id, expected_grade, tail_probability, selected` for every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches(stream, 500):
            tails = held.value.tails(held.value.scores(features, batch.column(1).to_pylist()))
            yield record({"doc_id": batch.column(0), "expected_grade": pa.array(tails.sum(axis=1)), "tail_probability": pa.array(tails[:, -1]), "selected": pa.array(tails[:, -1] >= select)})

    fields = schema(("doc_id", id_type(docs)), ("expected_grade", "double"), ("tail_probability", "double"), ("selected", "boolean"))
    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(run, fields)


def selected(docs: DataFrame, model: Ordinal, select: float = SELECT) -> DataFrame:
    """The rows and columns of the documents that are selected."""
    held, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches(stream, 500):
            texts = [(t or "").encode() for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(held.value.tails(held.value.scores(features, texts))[:, -1] >= select))

    return docs.mapInArrow(run, docs.schema)


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")
