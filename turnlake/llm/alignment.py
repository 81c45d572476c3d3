r"""Cross-tokenizer alignment: where the tokens of two tokenizers end together.

Tokenizer A is a byte-level BPE (a `tokenizers` file), tokenizer B a sentencepiece model that puts a space before the text;
both work on the bytes of space + text. The end offsets of A's and B's tokens are two ascending lists. They are intersected
by galloping: every element of the shorter list looks for itself in the longer one by steps that double, then by halving
the last step. The common ends cut the tokens into groups, and the ranks of a group's first and last token in both lists
are its ranges; the two tokens that end at a common offset are linked.

Batches of texts are worked on at once: their bytes are laid one after another, which makes one list of ends for each
tokenizer (every text's end is a common one). Element i of the shorter list starts where the first element of its run of
`RUN` was found, and that one where its text begins, so that all elements of a batch take their steps together.

Corpus counts of linked id pairs are added up in each task first, then shuffled by pair. The `HOT` most frequent pairs (a
fixed number of rows) are broadcast to the texts; links of rarer pairs are joined with their counts by pair. That is exact
for any corpus, and a pair beyond the first million is too rare to be a hot key.

Null and empty texts, and texts whose joined token bytes differ from space + text (such as those with U+2581 in them), have
no tokens. Every input row gives a row, whatever its id; rows are told apart by a number of their own. Only `doc_id` and
`text` are read. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnlake.llm.words import batches, id_type, record, schema
from turnlake.session import stored

RUN = 32  # elements that start their search at the same place
HOT = 1 << 20  # pairs whose counts are broadcast: 13 bytes each
BATCH = 1 << 20  # bytes of text that are aligned at once; a longer text is a batch of its own
HELD = 1 << 22  # pairs that a task adds up before it hands them on
# Fixed value: the pattern by which byte-level BPE divides texts before it merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WIDTH = 1 << 15  # ids of B in a pair's number


def gallop(short: np.ndarray, long: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Indices in both ascending lists of the values that they share."""
    if not len(short) or not len(long):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    heads = np.arange(0, len(short), run)
    begin = _first_at_least(short[heads], long, np.zeros(len(heads), np.int64))
    at = _first_at_least(short, long, np.repeat(begin, run)[: len(short)])
    known = np.flatnonzero(at < len(long))
    known = known[long[at[known]] == short[known]]
    return known, at[known]


def _first_at_least(wanted: np.ndarray, long: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The first index from `start` on whose value isn't below the wanted one; all searches take a step at a time."""
    last = len(long) - 1
    low, high, step = start.copy(), start.copy(), 1
    active = np.flatnonzero(low <= last)
    active = active[long[low[active]] < wanted[active]]  # `low` stays below the wanted value
    low, high = low - 1, high
    while len(active):
        low[active] = high[active]
        reach = high[active] + step
        high[active] = np.minimum(reach, last + 1)
        active = active[reach <= last]
        active = active[long[high[active]] < wanted[active]]
        step *= 2
    active = np.flatnonzero(high - low > 1)
    while len(active):
        middle = (low[active] + high[active]) >> 1
        below = long[middle] < wanted[active]
        low[active[below]] = middle[below]
        high[active[~below]] = middle[~below]
        active = active[high[active] - low[active] > 1]
    return high


def intersect(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the common values in both lists; the shorter list drives the search."""
    if len(a) <= len(b):
        return gallop(a, b)
    at_b, at_a = gallop(b, a)
    return at_a, at_b


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of A the first and last token of B that share a byte with it: the ranks of its edges in B's ends."""
    begins = np.concatenate(([0], a_ends[:-1]))
    first = _first_at_least(begins + 1, b_ends, np.zeros(len(a_ends), np.int64))
    return first, _first_at_least(a_ends, b_ends, first)


def _byte_decoder() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for 256 and on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTokens:
    """Tokenizer A and the bytes of its ids."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        decode = _byte_decoder()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.bytes[i] = bytes(decode[c] for c in entry) if all(c in decode for c in entry) else entry.encode()

        self.ranks = self._in_merge_order(json.loads(self.tokenizer.to_str())["model"])

    def _in_merge_order(self, model: dict):
        """tiktoken's encoder of the same entries, if ids follow the order of the merges, which it goes by; else None."""
        merges = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        if any(model["vocab"].get("".join(pair)) != 256 + i for i, pair in enumerate(merges)) or len(model["vocab"]) != 256 + len(merges):
            return None
        import tiktoken

        ranks = {self.bytes[i]: i for i in model["vocab"].values()}
        return tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Texts of Latin-1 characters, which all libraries' patterns class alike, go through the faster encoder of the two."""
        out, rest = [None] * len(texts), []
        for i, text in enumerate(texts):
            if self.ranks is not None and _is_latin(text):
                out[i] = self.ranks.encode_ordinary(f" {text}")
            else:
                rest.append(i)
        for i, found in zip(rest, self.tokenizer.encode_batch([f" {texts[i]}" for i in rest], add_special_tokens=False), strict=True):
            out[i] = found.ids
        return out


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class PieceTokens:
    """Tokenizer B and the bytes of its ids."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._piece(self.model.id_to_piece(i)) for i in range(self.model.get_piece_size())]

    @staticmethod
    def _piece(piece: str) -> bytes:
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@dataclass(frozen=True)
class Aligned:
    """A batch: ids and ends of all its texts one after another, the common ends' indices and each text's number of tokens."""

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    at_a: np.ndarray
    at_b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray

    @functools.cached_property
    def groups(self) -> np.ndarray:
        """Number of the first group of each text, then of all groups: a text's last group ends with its last token."""
        ends = np.cumsum(self.n_a)
        return np.concatenate(([0], np.searchsorted(self.at_a, ends - 1, "right")))

    def pairs(self) -> np.ndarray:
        return self.a[self.at_a] * WIDTH + self.b[self.at_b]

    def strings(self, table: list[str]) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` of each text: every token takes its place behind its group's earlier ones."""
        out = np.empty(len(self.a) + len(self.b), np.int64)
        of_a = np.repeat(np.arange(len(self.at_a)), np.diff(self.at_a, prepend=-1))
        of_b = np.repeat(np.arange(len(self.at_b)), np.diff(self.at_b, prepend=-1))
        before = np.concatenate(([0], self.at_b[:-1] + 1)) if len(self.at_b) else self.at_b
        mark_a, mark_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        mark_a[self.at_a], mark_b[self.at_b] = 1, 2
        mark_b[(np.cumsum(self.n_b) - 1)[self.n_b > 0]] = 3
        out[np.arange(len(self.a)) + before[of_a]] = self.a * 4 + mark_a
        out[np.arange(len(self.b)) + self.at_a[of_b] + 1] = self.b * 4 + mark_b
        parts, cuts = list(map(table.__getitem__, out.tolist())), [0, *np.cumsum(self.n_a + self.n_b).tolist()]
        return ["".join(parts[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]


class Aligner:
    """Both tokenizers; kept by a Python worker over its tasks."""

    def __init__(self, a: str, b: str) -> None:
        self.a, self.b = ByteTokens(a), PieceTokens(b)
        if len(self.b.bytes) > WIDTH or len(self.a.bytes) * WIDTH >= 1 << 31:
            raise ValueError("a pair's number takes 31 bits")
        self.lengths_a, self.lengths_b = (np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b))
        self.table = [f"{i}{mark}" for i in range(max(len(self.a.bytes), len(self.b.bytes))) for mark in (",", "|", ";", "")]

    def align(self, texts: list[str | None]) -> Aligned:
        held = [text or "" for text in texts]
        ids_a, ids_b = self.a.encode(held), self.b.encode(held)
        for i, text in enumerate(held):
            whole = f" {text}".encode()
            if not text or b"".join(map(self.a.bytes.__getitem__, ids_a[i])) != whole or b"".join(map(self.b.bytes.__getitem__, ids_b[i])) != whole:
                ids_a[i], ids_b[i] = [], []
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
        a, b = (np.concatenate([np.array(x, np.int64) for x in ids] or [np.zeros(0, np.int64)]) for ids in (ids_a, ids_b))
        a_ends, b_ends = np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])
        return Aligned(a, b, a_ends, b_ends, *intersect(a_ends, b_ends), n_a, n_b)


@functools.cache
def aligner(a: str, b: str) -> Aligner:
    return Aligner(a, b)


def _by_size(stream: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most `BATCH` bytes of text, or of one text."""
    for batch in batches(stream, 4096):
        start, ends = 0, np.cumsum(pc.binary_length(batch.column(at)).fill_null(0).to_numpy())
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + BATCH, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def alignments(docs: DataFrame, a: str, b: str) -> DataFrame:
    """`doc_id, a, b` (ids), `a_ends, b_ends` (byte offsets in space + text), `groups` (`end`, and the number of the last token
    of A and of B in the group) and `overlap` (per token of A the first and last token of B that share a byte with it).
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a, b)
        for batch in batches(stream, 64):
            out = {k: [] for k in ("a", "b", "a_ends", "b_ends", "groups", "overlap")}
            for text in batch.column(1).to_pylist():
                found = both.align([text])
                for k in ("a", "b", "a_ends", "b_ends"):
                    out[k].append(getattr(found, k))
                out["groups"].append([{"end": int(found.a_ends[i]), "last_a": int(i), "last_b": int(j)} for i, j in zip(found.at_a, found.at_b, strict=True)])
                first, last = overlaps(found.a_ends, found.b_ends)
                out["overlap"].append([{"first_b": int(i), "last_b": int(j)} for i, j in zip(first, last, strict=True)])
            kinds = {"groups": _GROUPS, "overlap": _OVERLAP}
            yield record({"doc_id": batch.column(0)} | {k: pa.array(v, kinds.get(k, pa.list_(pa.int64()))) for k, v in out.items()})

    lists = [(k, "array<bigint>") for k in ("a", "b", "a_ends", "b_ends")]
    fields = schema(
        ("doc_id", id_type(docs)), *lists, ("groups", "array<struct<end:bigint,last_a:bigint,last_b:bigint>>"),
        ("overlap", "array<struct<first_b:bigint,last_b:bigint>>"),
    )
    return docs.select("doc_id", "text").mapInArrow(run, fields)


_GROUPS = pa.list_(pa.struct([("end", pa.int64()), ("last_a", pa.int64()), ("last_b", pa.int64())]))
_OVERLAP = pa.list_(pa.struct([("first_b", pa.int64()), ("last_b", pa.int64())]))


def linked(docs: DataFrame, a: str, b: str) -> DataFrame:
    """`row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256` and the text's linked id pairs with their number of links."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a, b)
        for batch in _by_size(stream, 2):
            found = both.align(batch.column(2).to_pylist())
            n, groups = batch.num_rows, found.groups
            owner = np.repeat(np.arange(n), np.diff(groups))
            keys, times = np.unique(owner << 32 | found.pairs(), return_counts=True)
            cuts = np.searchsorted(keys >> 32, np.arange(n + 1)).astype(np.int32)
            digests = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in found.strings(both.table)]
            lists = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x.astype(np.int32))) for x in (keys & 0xFFFFFFFF, times)]
            yield record({
                "row": batch.column(0), "doc_id": batch.column(1), "n_a": pa.array(found.n_a), "n_b": pa.array(found.n_b), "n_groups": pa.array(np.diff(groups)),
                "n_links": pa.array(np.diff(groups)), "groups_sha256": pa.array(digests), "pairs": lists[0], "times": lists[1],
            })

    counts = [(k, "bigint") for k in ("n_a", "n_b", "n_groups", "n_links")]
    fields = schema(("row", "bigint"), ("doc_id", id_type(docs)), *counts, ("groups_sha256", "string"), ("pairs", "array<int>"), ("times", "array<int>"))
    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(run, fields)


def pair_counts(links: DataFrame) -> DataFrame:
    """`pair, n, best`: the links of each id pair in the corpus, and whether no pair with the same id of B has more."""

    def summed(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, times, waiting, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def merge() -> None:
            nonlocal pairs, times, waiting, size
            every = [np.concatenate(x) for x in zip((pairs, times), *waiting, strict=True)]
            pairs, place = np.unique(every[0], return_inverse=True)
            times, waiting, size = np.bincount(place, every[1], len(pairs)).astype(np.int64), [], 0

        def made() -> pa.RecordBatch:
            return record({"pair": pa.array(pairs), "n": pa.array(times)})

        for batch in batches(stream, 1024):
            waiting.append([batch.column(k).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1)])
            size += len(waiting[-1][0])
            if size > HELD:
                merge()
                if len(pairs) > HELD:
                    yield made()
                    pairs, times = pairs[:0], times[:0]
        merge()
        yield made()

    counts = links.select("pairs", "times").mapInArrow(summed, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = stored(counts.withColumn("b", F.pmod("pair", F.lit(WIDTH))), "alignment-pairs")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))  # a row per id of B: the vocabulary bounds it
    return counts.join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def scored(links: DataFrame, counts: DataFrame, hot: int = HOT) -> DataFrame:
    """`links` with `n_best` and `count_sum` in place of the pairs."""
    first = counts.orderBy(F.desc("n"), "pair").limit(hot).toArrow()
    order = np.argsort(first["pair"].to_numpy())
    table = tuple(first[k].to_numpy(zero_copy_only=False)[order] for k in ("pair", "n", "best"))
    held = links.sparkSession.sparkContext.broadcast((table[0].astype(np.int32), table[1], table[2]))
    keep = [c for c in links.columns if c not in ("pairs", "times")]
    at, width = links.columns.index("pairs"), len(keep)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, numbers, best = held.value
        for batch in batches(stream, 1024):
            lists = batch.column(at)
            pairs, times = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in (at, at + 1))
            owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            place = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
            met = known[place] == pairs if len(known) else np.zeros(len(pairs), bool)
            place, weight = place[met], times[met].astype(np.int64)
            n_best, sums = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(n_best, owner[met], weight * best[place])
            np.add.at(sums, owner[met], weight * numbers[place])
            cuts = np.searchsorted(owner[~met], np.arange(batch.num_rows + 1)).astype(np.int32)
            rare = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x[~met])) for x in (pairs, times)]
            rest = {"n_best": pa.array(n_best), "count_sum": pa.array(sums), "pairs": rare[0], "times": rare[1]}
            yield record({c: batch.column(c) for c in keep} | rest)

    fields = T.StructType(links.select(keep).schema.fields)
    for name, kind in (("n_best", "bigint"), ("count_sum", "bigint"), ("pairs", "array<int>"), ("times", "array<int>")):
        fields = fields.add(name, T.DataType.fromDDL(kind))
    assert width == at  # the lists come last
    found = stored(links.mapInArrow(run, fields), "alignment-scored")
    rare = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").cast("long").alias("pair"), F.col("x.times").alias("times"))
    added = rare.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
    )
    return found.drop("pairs", "times").join(added, "row", "left").select(
        *keep, (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"), (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum")
    )


def link_counts(docs: DataFrame, a: str, b: str, hot: int = HOT) -> DataFrame:
    """`doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256` for every row."""
    links = stored(linked(docs, a, b), "alignment-links")
    return scored(links, stored(pair_counts(links), "alignment-counts"), hot).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
