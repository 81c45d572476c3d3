"""Benchmark decontamination with an FM-index per training shard.

The test phrases are all windows of `WINDOW` consecutive words of a benchmark item (a shorter item is one window). A shard
is a run of documents of one Spark partition with about `SHARD` words. Words that occur in no phrase can't be part of an
occurrence, so the shard's index holds the stretches of phrase words that are at least as long as the shortest window,
with separators between them: the index stays small however long the documents are. Phrases are searched backwards
through the ranks of a wavelet matrix, all at once; occurrences are located by walking to the nearest sampled suffix, and
their word spans are merged per document.

Documents are never shuffled. The phrases are a stated query set: they are dealt into blocks of `BLOCK_BYTES` of item
text, and every block is one pass over the documents that carries the spans found so far along, so any number of items
will do and only one block is broadcast at a time.

Null texts have no words and are clean, as is everything when there are no items. Items without words have no windows;
items with equal ids count once, a null id counts as "null". Repeated documents give repeated results. Columns of other
names, also those of the result, may be in the table. An empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnlake.llm.words import batches, fresh, plain_words, text_bytes

WINDOW = 13
SHARD = 2_000_000
SAMPLE = 16  # every so many text positions one suffix is stored
BLOCK_BYTES = 16 << 20
_END, _BREAK, _FIRST = 0, 1, 2  # symbols: the text's end, between stretches, the first word
SPANS = "array<struct<start:bigint,end:bigint>>"


class Bits:
    """A bit vector with ranks."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]))

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & below)

    def at(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1


class WaveletMatrix:
    """Symbols by bit levels from the highest: at each level zeros go first, in order."""

    def __init__(self, symbols: np.ndarray, sigma: int) -> None:
        self.shifts = list(range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1))
        self.levels: list[tuple[Bits, int]] = []
        for shift in self.shifts:
            ones = (symbols >> shift & 1).astype(bool)
            self.levels.append((Bits(ones), int(len(ones) - ones.sum())))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))
        every = np.arange(sigma)
        self.base = self._down(every, np.zeros(sigma, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, (bits, zeros) in zip(self.shifts, self.levels, strict=True):
            ones = bits.rank(i)
            i = np.where(symbol >> shift & 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often the symbol occurs before position i."""
        return self._down(symbol, i) - self.base[symbol]

    def symbol_and_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at position i and how often it occurs before."""
        symbol = np.zeros(len(i), np.int64)
        for shift, (bits, zeros) in zip(self.shifts, self.levels, strict=True):
            one, ones = bits.at(i), bits.rank(i)
            symbol |= one.astype(np.int64) << shift
            i = np.where(one, zeros + ones, i - ones)
        return symbol, i - self.base[symbol]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; the last symbol is unique and the least."""
    rank, n, width = text.astype(np.int64), len(text), 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-width] = rank[width:] + 1
        key = rank * (int(after.max()) + 1) + after
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        places = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1])))
        if places[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = places
        width *= 2


class FMIndex:
    def __init__(self, text: np.ndarray, sigma: int) -> None:
        order = suffix_array(text)
        self.n = len(text)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))[:-1]))
        self.last = WaveletMatrix(text[order - 1], sigma)
        sampled = order % SAMPLE == 0
        self.sampled, self.positions = Bits(sampled), order[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of equally long phrases: the numbers of those that occur and their suffix ranges."""
        alive = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n)
        for j in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, j]
            low, high = self.first[symbol] + self.last.rank(symbol, low), self.first[symbol] + self.last.rank(symbol, high)
            left = low < high
            alive, low, high = alive[left], low[left], high[left]
        return alive, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: steps to the left until a sampled one."""
        out, open_, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        while len(rows):
            known = self.sampled.at(rows)
            out[open_[known]] = self.positions[self.sampled.rank(rows[known])] + steps
            rows, open_ = rows[~known], open_[~known]
            symbol, before = self.last.symbol_and_rank(rows)
            rows, steps = self.first[symbol] + before, steps + 1
        return out


@dataclass
class Phrases:
    """Distinct windows of a block of items, by length, with the items that each stands for."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    windows: dict[int, np.ndarray] = field(default_factory=dict)
    owners: dict[int, list[list[str]]] = field(default_factory=dict)

    @classmethod
    def of(cls, items: list[tuple[str, bytes]], window: int = WINDOW) -> Phrases:
        made, found = cls(), defaultdict(dict)
        for name, text in items:
            ids = [made.vocabulary.setdefault(w, len(made.vocabulary) + _FIRST) for w in plain_words(text)]
            for i in range(max(1, len(ids) - window + 1)) if ids else ():
                key = tuple(ids[i : i + window])
                found[len(key)].setdefault(key, set()).add(name)
        for length, keys in found.items():
            made.windows[length] = np.array(list(keys), np.int64).reshape(-1, length)
            made.owners[length] = [sorted(names) for names in keys.values()]
        return made

    @property
    def shortest(self) -> int:
        return min(self.windows)


def _stretches(ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of runs of phrase words of at least that length."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], (ids > 0).astype(np.int8), [0]))))
    begins, ends = edges[::2], edges[1::2]
    long = ends - begins >= least
    return begins[long], ends[long]


def merged(spans: np.ndarray) -> np.ndarray:
    """Rows (document, start, end) with overlapping and touching spans of a document made one."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    far = int(spans[:, 2].max()) + 1
    reach = np.maximum.accumulate(spans[:, 0] * far + spans[:, 2])
    fresh_ = np.concatenate(([True], spans[1:, 0] * far + spans[1:, 1] > reach[:-1]))
    starts = np.flatnonzero(fresh_)
    ends = reach[np.concatenate((starts[1:], [len(spans)])) - 1]
    return np.stack((spans[starts, 0], spans[starts, 1], ends - spans[starts, 0] * far), axis=1)


def shard_hits(texts: list[bytes], phrases: Phrases) -> tuple[list[int], np.ndarray, dict[int, set[str]]]:
    """(number of words of each text, merged word spans as rows (text, start, end), items by text)."""
    sizes, get = [], phrases.vocabulary.get
    if not phrases.windows:
        return [len(plain_words(t)) for t in texts], np.zeros((0, 3), np.int64), {}
    parts, at, owner, offset, filled = [], [], [], [], 0
    least = phrases.shortest
    for number, text in enumerate(texts):
        words = plain_words(text)
        sizes.append(len(words))
        ids = np.array([get(w, 0) for w in words], np.int64)
        for begin, end in zip(*_stretches(ids, least), strict=True):
            parts += [ids[begin:end], np.array([_BREAK])]
            at.append(filled)
            owner.append(number)
            offset.append(begin)
            filled += end - begin + 1
    if not parts:
        return sizes, np.zeros((0, 3), np.int64), {}
    index = FMIndex(np.concatenate([*parts, [_END]]), len(phrases.vocabulary) + _FIRST)
    at, owner, offset = np.array(at), np.array(owner), np.array(offset)
    spans, items = [np.zeros((0, 3), np.int64)], defaultdict(set)
    for length, windows in phrases.windows.items():
        found, low, high = index.search(windows)
        counts = high - low
        rows = np.repeat(low - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
        places = index.locate(rows)
        run = np.searchsorted(at, places, "right") - 1
        text, start = owner[run], offset[run] + places - at[run]
        spans.append(np.stack((text, start, start + length), axis=1))
        held = np.unique(text * len(windows) + np.repeat(found, counts))
        for text_number, window in zip(held // len(windows), held % len(windows), strict=True):
            items[int(text_number)].update(phrases.owners[length][window])
    return sizes, merged(np.concatenate(spans)), items


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of about that many bytes of text."""
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), text_bytes().alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // block_bytes))
    for block in range(n):
        yield [(r["item"], bytes(r["text"])) for r in rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == block).collect()]


def located(docs: DataFrame, items: DataFrame, names: dict[str, str], window: int = WINDOW, block_bytes: int = BLOCK_BYTES, shard: int = SHARD) -> DataFrame:
    """All rows and columns of `docs`, and as named: `n_words`, `spans` (of words, merged) and `items` (sorted ids)."""
    spark = docs.sparkSession
    out = docs.withColumns({names["n_words"]: F.lit(0).cast("long"), names["spans"]: F.array().cast(SPANS), names["items"]: F.array().cast("array<string>")})
    at = {key: out.columns.index(name) for key, name in names.items()}
    text_at = docs.columns.index("text")
    for block in _blocks(items, block_bytes):
        held = spark.sparkContext.broadcast(Phrases.of(block, window))

        def run(stream: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            phrases, waiting, size = held.value, [], 0

            def searched() -> Iterator[pa.RecordBatch]:
                texts = [(t or "").encode() for batch in waiting for t in batch.column(text_at).to_pylist()]
                sizes, spans, found = shard_hits(texts, phrases)
                first = 0
                for batch in waiting:
                    old_spans, old_items = batch.column(at["spans"]), batch.column(at["items"])
                    mine = spans[(spans[:, 0] >= first) & (spans[:, 0] < first + batch.num_rows)]
                    new_spans, new_items = old_spans, old_items
                    if len(mine):
                        lists, names_ = old_spans.to_pylist(), old_items.to_pylist()
                        for i in np.unique(mine[:, 0]):
                            rows = [(0, s["start"], s["end"]) for s in lists[i - first]] + [(0, s, e) for _, s, e in mine[mine[:, 0] == i]]
                            lists[i - first] = [{"start": int(s), "end": int(e)} for _, s, e in merged(np.array(rows, np.int64))]
                            names_[i - first] = sorted({*names_[i - first], *found[int(i)]})
                        new_spans, new_items = pa.array(lists, old_spans.type), pa.array(names_, old_items.type)
                    columns = list(batch.columns)
                    columns[at["n_words"]] = pa.array(sizes[first : first + batch.num_rows], pa.int64())
                    columns[at["spans"]], columns[at["items"]] = new_spans, new_items
                    yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)
                    first += batch.num_rows

            for batch in batches(stream, 1000):
                waiting.append(batch)
                size += batch.column(text_at).nbytes // 6
                if size >= shard:
                    yield from searched()
                    waiting, size = [], 0
            if waiting:
                yield from searched()

        out = out.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType, True) for f in out.schema.fields]))
    return out


def _hit(spans: str) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def _contaminated(n_words: str, spans: str) -> Column:
    return (_hit(spans) > 0) & (20 * _hit(spans) >= F.col(n_words))


def contamination(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """`doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans` for every row.

    A document is contaminated if hit words are at least a twentieth of its words.
    """
    names = {"n_words": "n_words", "spans": "spans", "items": "items"}
    found = located(docs.select("doc_id", F.col("text").cast("string").alias("text")), items, names, **how)
    return found.select(
        "doc_id", "n_words", _hit("spans").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), _contaminated("n_words", "spans").alias("contaminated"), "spans",
    )


def decontaminated(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """The rows and columns of the documents that are not contaminated."""
    names = {key: fresh(docs, f"decontamination_{key}") for key in ("n_words", "spans", "items")}
    return located(docs, items, names, **how).where(~_contaminated(names["n_words"], names["spans"])).select(*docs.columns)
