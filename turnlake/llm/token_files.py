"""Token ids in bit-plane-shuffled, compressed chunks.

Texts are encoded, ended with `END` and laid one after another in ascending order of `doc_id`. The ids of a shard (a range
of documents) are cut into chunks of `CHUNK` ids. A chunk is transposed into byte planes (all lowest bytes, all second
bytes, ...) and every plane is compressed with zstandard: the high planes are nearly constant and almost vanish.

A folder holds `chunks` (`shard, chunk, first, n_ids, planes, ids, counts, opens, closes`: the planes and, as the chunk's
index, which documents have how many ids in it, whether it begins with a document's first id and ends with one's last)
and `shards` (`shard, n_ids, start`, the place of each shard's first id). Both are
Parquet tables written by Spark, so half-written files of lost executors never show, and any store that Spark writes to
will do. Chunks are self-contained: any of them can be read alone, and readers work chunk by chunk.

Null texts are empty and have the end id only. Rows with equal ids lie together, ordered by their ids' checksum; rows
with a null id come first. Only `doc_id` and `text` are read. An empty table gives empty tables.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnlake.llm.words import batches, id_type, record, schema, space_words, text_bytes
from turnlake.session import new_folder, stored

END = 1
CHUNK = 65_536
SHARD = 32 << 20  # bytes of text in a shard
CACHE = 700_000  # new words after which a worker forgets those that it has not met again
_TAIL = b".,!?;:%$&#*|"


@dataclass(frozen=True)
class TokenFiles:
    folder: str

    def chunks(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/chunks")

    def shards(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/shards")


class Words(dict):
    """Ids of words, each made when it is first met.

    A word that is not yet known is divided once more between letters or digits and the punctuation after them, where the
    tokenizer divides as well, so that "word", "word," and "word." share their work. A part of letters only is a single
    pre-token, so the library's model alone can encode it.
    """

    def __init__(self, tokenizer) -> None:
        self.tokenizer, self.model, self.normalizer = tokenizer, tokenizer.model, tokenizer.normalizer
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        self[word] = ids = self._made(word) if ids is None else ids
        return ids

    def _made(self, word: bytes) -> bytes:
        stem = word.rstrip(_TAIL)
        if stem and stem != word and self._plain(stem)[-1:].isalnum():
            return self[stem] + self[word[len(stem) :]]
        text, plain = word.decode(), self._plain(word)
        if plain.isalpha():
            ids = [token.id for token in self.model.tokenize(plain if plain.isascii() else _byte_letters(plain))]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _plain(self, word: bytes) -> str:
        """As the tokenizer normalizes it; ASCII words are lower-case already."""
        return word.decode() if word.isascii() else self.normalizer.normalize_str(word.decode())

    def forget(self) -> None:
        """Drops the words that were not used since the last time."""
        self.older = dict(self)
        self.clear()


class Encoder:
    """Encodes texts word by word and remembers the words.

    White space always ends a token of the vocabulary named by `path`, so a text's ids are its words' ids one after
    another; the tokenizer lower-cases as well.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = Words(self.tokenizer)

    def __call__(self, text: bytes) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if b"<|" in text:  # the vocabulary's special tokens may be in it
            return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()
        if len(self.words) > CACHE:
            self.words.forget()
        return b"".join(map(self.words.__getitem__, space_words(text)))


def _byte_alphabet() -> dict[int, str]:
    """The printable stand-ins of the byte-level alphabet: printable bytes stand for themselves, the others for 256 and on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


_ALPHABET = _byte_alphabet()


def _byte_letters(text: str) -> str:
    return text.encode().decode("latin-1").translate(_ALPHABET)


@functools.cache
def encoder(path: str) -> Encoder:
    """One for each Python worker, kept over tasks."""
    return Encoder(path)


def _planes(ids: np.ndarray) -> list[bytes]:
    packed = zstandard.ZstdCompressor(level=3)
    rows = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return [packed.compress(plane.tobytes()) for plane in rows]


def _unplaned(planes: list[bytes], n: int) -> np.ndarray:
    plain = zstandard.ZstdDecompressor()
    rows = np.stack([np.frombuffer(plain.decompress(p, max_output_size=n), np.uint8) for p in planes])
    return np.ascontiguousarray(rows.T).view("<u4").ravel()


def write(docs: DataFrame, path: str, folder: str, chunk: int = CHUNK, end: int = END, shard_bytes: int = SHARD) -> TokenFiles:
    """Encodes the documents and writes the files to `folder`.

    Texts are dealt out by ranges of ids first, so that they are encoded just once, where their ids are packed; the
    ranges are found from a sample of the ids.
    """
    spark, kind = docs.sparkSession, id_type(docs)
    rows = docs.select("doc_id", text_bytes().alias("text"))
    shards = max(1, -(-int(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // shard_bytes))
    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered = ordered.select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    last = np.array([end], "<u4").tobytes()

    def pack(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        held, names, counts, filled, number, shard, opens = [], [], [], 0, 0, 0, True

        def flush(closes: bool) -> pa.RecordBatch:
            nonlocal held, names, counts, filled, number, opens
            ids = np.concatenate(held)
            out = {
                "shard": pa.array([shard], pa.int32()), "chunk": pa.array([number], pa.int64()), "first": pa.array([number * chunk], pa.int64()),
                "n_ids": pa.array([len(ids)], pa.int64()), "planes": pa.array([_planes(ids)], pa.list_(pa.binary())),
                "ids": pa.ListArray.from_arrays([0, len(names)], pa.concat_arrays(names)), "counts": pa.array([counts], pa.list_(pa.int64())),
                "opens": pa.array([opens]), "closes": pa.array([closes]),
            }
            held, names, counts, filled, number, opens = [], [], [], 0, number + 1, closes
            return record(out)

        for batch in batches(stream, 256):
            for i, text in enumerate(batch.column(2).to_pylist()):
                ids, shard = np.frombuffer(encode(text) + last, "<u4"), batch.column(0)[0].as_py()
                while len(ids):
                    piece = ids[: chunk - filled]
                    held.append(piece)
                    names.append(batch.column(1).slice(i, 1))
                    counts.append(len(piece))
                    filled, ids = filled + len(piece), ids[len(piece) :]
                    if filled == chunk:
                        yield flush(not len(ids))
        if filled:
            yield flush(True)

    fields = schema(
        ("shard", "int"), ("chunk", "bigint"), ("first", "bigint"), ("n_ids", "bigint"), ("planes", "array<binary>"),
        ("ids", T.ArrayType(kind)), ("counts", "array<bigint>"), ("opens", "boolean"), ("closes", "boolean"),
    )
    ordered.mapInArrow(pack, fields).write.option("compression", "none").parquet(f"{folder}/chunks")
    files = TokenFiles(folder)
    sums = files.chunks(spark).groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # one row per shard
    sums.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).write.parquet(f"{folder}/shards")
    return files


def pieces(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """What each chunk holds of each document: `shard, doc_id, at, n` and `crc` of a whole document, or `raw` (the ids) of a
    piece whose document goes on in another chunk; `opens`: it is the document's first.
    """
    chunks = files.chunks(spark)
    kind = chunks.schema["ids"].dataType.elementType

    def unpack(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream, 1):
            shard, first, n, planes, counts, opens, closes = (batch.column(k)[0].as_py() for k in (0, 1, 2, 3, 5, 6, 7))
            ids, ends = _unplaned(planes, n), np.cumsum(counts)
            raw = [ids[a:b].tobytes() for a, b in zip(ends - counts, ends, strict=True)]
            opened, whole = np.ones(len(raw), bool), np.ones(len(raw), bool)
            opened[0], whole[0], whole[-1] = opens, opens, (opens if len(raw) == 1 else True) and closes
            yield record({
                "shard": pa.array(np.full(len(raw), shard), pa.int32()), "doc_id": batch.column(4).flatten(),
                "at": pa.array(first + ends - counts), "n": pa.array(counts, pa.int64()),
                "crc": pa.array([zlib.crc32(r) if w else None for r, w in zip(raw, whole, strict=True)], pa.int64()),
                "raw": pa.array([None if w else r for r, w in zip(raw, whole, strict=True)], pa.binary()), "opens": pa.array(opened),
            })

    fields = schema(("shard", "int"), ("doc_id", kind), ("at", "bigint"), ("n", "bigint"), ("crc", "bigint"), ("raw", "binary"), ("opens", "boolean"))
    return chunks.select("shard", "first", "n_ids", "planes", "ids", "counts", "opens", "closes").mapInArrow(unpack, fields)


def documents(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """`doc_id, start, n_tokens, ids_crc32` of every document, from the files.

    Only the pieces at chunk edges are shuffled, by shard: two rows per chunk at most, in their order.
    """
    found = stored(pieces(spark, files), "token-pieces")
    whole = found.where("crc is not null").select("shard", "doc_id", "at", "n", "crc")
    order = W.partitionBy("shard").orderBy("at")
    torn = found.where("crc is null").withColumn("document", F.sum(F.col("opens").cast("long")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    joined = F.aggregate(F.sort_array(F.collect_list(F.struct("at", "raw"))), F.lit(b""), lambda done, x: F.concat(done, x["raw"]))
    torn = torn.groupBy("shard", "document").agg(F.first("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n"), F.crc32(joined).alias("crc"))
    rows = whole.unionByName(torn.select("shard", "doc_id", "at", "n", "crc"))
    starts = files.shards(spark).select("shard", "start")
    return rows.join(starts, "shard").select("doc_id", (F.col("start") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))


def written(docs: DataFrame, path: str) -> DataFrame:
    """Writes the documents to a new folder of the shared one and reads them back."""
    spark = docs.sparkSession
    return documents(spark, write(docs, path, new_folder(spark, "token-files")))
