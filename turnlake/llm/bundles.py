r"""Seekable Zstandard bundles of WARC records.

A bundle is a complete `.warc.zst` file: independent frames of whole records (about `FRAME` bytes each), then a seek table
in a skippable frame, whose footer tells the number of frames. Any reader of the seekable format finds a frame's place from
the footer, and any Zstandard reader gets the archive by decompressing the file from its start. The record index maps each
record's identifier to its bundle, frame, offset in the frame's plain bytes and length, so one record costs one frame.

Bundles are rows of a Parquet table (`bundle, data` and the index as lists), written by Spark: half-written bundles of lost
executors never show, and any store that Spark writes to will do. A bundle ends at `BUNDLE` plain bytes; one larger record
is a bundle of its own.

Equal payloads of at least `SMALL` bytes (same length and SHA-256) are stored once: the row with the largest page_id is the
response, the others are revisits without a payload that name it. Digests are grouped before any payload is moved; payloads
are shuffled once, by a number of their row, so neither a payload nor an id that a third of the rows have makes a hot task.

A null html is an empty payload. A null page_id is less than any other; of rows with the same page_id and payload the last
read is the response. A null url gives a record without a target; what a url can't
hold is percent-encoded. Only `page_id, url, html` are read; the table must give its rows in the same order when read again, as
files do. An empty table gives no bundles.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import urllib.parse
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnlake.llm.words import batches, id_type, record, schema
from turnlake.session import new_folder, stored

SMALL = 1000  # bytes: smaller payloads are always stored
FRAME = 1 << 18
BUNDLE = 1 << 22
ROW_GROUP = 1 << 24  # bytes of bundles that a reader holds at once
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"  # pages don't say when they were fetched
# Fixed values of the seekable format: the skippable frame's magic number and the footer's.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
# Fixed values of WARC 1.1.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URL = "".join(map(chr, range(0x21, 0x7F)))


def record_id(page: object, row: int) -> str:
    """Unique by the row's number; reruns agree."""
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page}:{row}')}"


def target(url: str) -> str:
    """The url as a record names it: white space, control and non-ASCII characters are percent-encoded."""
    return urllib.parse.quote(url, safe=_URL)


def sha1_label(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def warc_record(kind: str, name: str, url: str | None, payload: bytes, digest: bytes, refers_to: str | None = None, date: str = DATE) -> bytes:
    """One record; a revisit keeps the HTTP header, whose Content-Length is the payload's, and leaves the payload out."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{name}>", "WARC-Date": date}
    if url is not None:
        head["WARC-Target-URI"] = target(url)
    head["WARC-Payload-Digest"] = sha1_label(digest)
    if kind == "revisit":
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<{refers_to}>"}
    else:
        block += payload
    head |= {"Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


@dataclass(frozen=True)
class Record:
    head: dict[str, str]
    http: dict[str, str]
    payload: bytes


def _fields(lines: list[bytes]) -> dict[str, str]:
    return {k.decode().strip(): v.decode().strip() for k, _, v in (line.partition(b":") for line in lines if line)}


def parsed(plain: memoryview | bytes, at: int = 0) -> tuple[Record, int]:
    """The record that begins at `at` and where the next one begins."""
    plain = bytes(plain) if isinstance(plain, memoryview) else plain
    stop = plain.index(b"\r\n\r\n", at)
    first, *lines = plain[at:stop].split(b"\r\n")
    if first != b"WARC/1.1":
        raise ValueError(f"no record begins at {at}")
    head = _fields(lines)
    begin, end = stop + 4, stop + 4 + int(head["Content-Length"])
    cut = plain.index(b"\r\n\r\n", begin, end) + 4
    if plain[end : end + 4] != b"\r\n\r\n":
        raise ValueError(f"the record at {at} doesn't end where its length says")
    return Record(head, _fields(plain[begin : cut - 4].split(b"\r\n")[1:]), plain[cut:end]), end + 4


class BundleWriter:
    """Collects records into frames; `close` gives the file."""

    def __init__(self, frame: int = FRAME, level: int = LEVEL) -> None:
        self.frame, self.packer = frame, zstandard.ZstdCompressor(level=level, write_checksum=False)
        self.out, self.sizes, self.held, self.filled, self.plain = [], [], [], 0, 0

    def add(self, data: bytes) -> tuple[int, int]:
        """(frame, offset in the frame's plain bytes)."""
        if self.filled and self.filled + len(data) > self.frame:
            self._flush()
        place = len(self.sizes), self.filled
        self.held.append(data)
        self.filled, self.plain = self.filled + len(data), self.plain + len(data)
        return place

    def _flush(self) -> None:
        packed = self.packer.compress(b"".join(self.held))
        self.out.append(packed)
        self.sizes.append((len(packed), self.filled))
        self.held, self.filled = [], 0

    def close(self) -> bytes:
        if self.held:
            self._flush()
        entries = b"".join(struct.pack("<II", *size) for size in self.sizes)
        table = entries + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        return b"".join(self.out) + struct.pack("<II", SKIPPABLE, len(table)) + table


class BundleReader:
    """Random access by the seek table at the file's end."""

    def __init__(self, data: bytes) -> None:
        n, flags, magic = struct.unpack("<IBI", data[-9:])
        start = len(data) - 9 - 8 * n
        if magic != SEEKABLE or flags or struct.unpack("<II", data[start - 8 : start]) != (SKIPPABLE, 8 * n + 9):
            raise ValueError("no seek table")
        self.data, self.places, at = data, [], 0
        for packed, plain in struct.iter_unpack("<II", data[start:-9]):
            self.places.append((at, at + packed, plain))
            at += packed
        if at != start - 8:
            raise ValueError("the frames don't fill the file")
        self.unpacker = zstandard.ZstdDecompressor()

    def frame(self, number: int) -> bytes:
        begin, end, plain = self.places[number]
        return self.unpacker.decompress(self.data[begin:end], max_output_size=plain)

    def records(self) -> Iterator[Record]:
        for number in range(len(self.places)):
            plain, at = self.frame(number), 0
            while at < len(plain):
                found, at = parsed(plain, at)
                yield found


@dataclass(frozen=True)
class Bundles:
    folder: str

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/bundles")

    def index(self, spark: SparkSession) -> DataFrame:
        """`record_id, page_id, bundle, frame, offset, length` of every record; the bundles themselves aren't read."""
        return self.table(spark).select("bundle", F.explode("records").alias("r")).select("r.record_id", "r.page_id", "bundle", "r.frame", "r.offset", "r.length")


def _payload() -> Column:
    return F.coalesce(F.col("html"), F.lit("")).cast("binary")


def decided(pages: DataFrame) -> DataFrame:
    """`row, first_row, first_page` of the rows whose payload another row stores: narrow rows only."""
    narrow = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", _payload().alias("p"))
    narrow = narrow.select("row", "page_id", F.sha2("p", 256).alias("sha"), F.octet_length("p").alias("n")).where(F.col("n") >= SMALL)
    narrow = stored(narrow, "bundle-digests")
    best = F.max(F.struct(F.col("page_id").isNotNull().alias("named"), "page_id", "row"))
    groups = narrow.groupBy("sha", "n").agg(best.alias("best"), F.count(F.lit(1)).alias("size")).where("size > 1")
    groups = stored(groups.select("sha", "n", F.col("best.page_id").alias("first_page"), F.col("best.row").alias("first_row")), "bundle-groups")
    return narrow.join(groups, ["sha", "n"]).where("row <> first_row").select("row", "first_row", "first_page")


def write(pages: DataFrame, folder: str, frame: int = FRAME, bundle: int = BUNDLE, date: str = DATE) -> Bundles:
    spark, kind = pages.sparkSession, id_type(pages, "page_id")
    revisits = stored(decided(pages), "bundle-revisits")
    rows = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", "url", _payload().alias("payload"))
    rows = rows.join(revisits, "row", "left").sortWithinPartitions("row").select("row", "page_id", "url", "payload", "first_row", "first_page")

    def pack(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        writer, index = BundleWriter(frame), []

        def flush() -> pa.RecordBatch:
            nonlocal writer, index, number
            out = {"bundle": pa.array([f"{part:06d}-{number:06d}"]), "data": pa.array([writer.close()], pa.binary()), "records": pa.array([index], records)}
            writer, index, number = BundleWriter(frame), [], number + 1
            return record(out)

        for batch in batches(stream, 64):
            records = pa.list_(_record_type(batch.schema.field(1).type))
            for i in range(batch.num_rows):
                row, page, url, payload, first_row, first_page = (batch.column(k)[i].as_py() for k in range(6))
                digest, name = hashlib.sha1(payload).digest(), record_id(page, row)
                if first_row is None:
                    data = warc_record("response", name, url, payload, digest, date=date)
                else:
                    data = warc_record("revisit", name, url, payload, digest, record_id(first_page, first_row), date)
                if writer.plain and writer.plain + len(data) > bundle:
                    yield flush()
                at = writer.add(data)
                index.append({"record_id": name, "page_id": page, "frame": at[0], "offset": at[1], "length": len(data)})
        if index:
            yield flush()

    items = f"array<struct<record_id:string,page_id:{kind.simpleString()},frame:bigint,offset:bigint,length:bigint>>"
    made = rows.mapInArrow(pack, schema(("bundle", "string"), ("data", "binary"), ("records", items)))
    made.write.option("compression", "zstd").option("parquet.block.size", str(ROW_GROUP)).parquet(f"{folder}/bundles")
    return Bundles(folder)


def _record_type(page: pa.DataType) -> pa.DataType:
    return pa.struct([("record_id", pa.string()), ("page_id", page), ("frame", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])


def read(spark: SparkSession, bundles: Bundles) -> DataFrame:
    """Every record of the archives: `record_id, record_type, url, refers_to_record, payload_bytes, payload_digest, payload`.

    Each frame is found by the seek table and decompressed by itself. A stored payload must have the digest and length that
    its record tells, else the read fails; a revisit has no payload here.
    """

    def unpack(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream, 1):
            for found in _in_lots(BundleReader(batch.column(0)[0].as_py()).records()):
                yield record({name: pa.array([row[i] for row in found], kind) for i, (name, kind) in enumerate(_READ)})

    fields = schema(*((name, "bigint" if kind == pa.int64() else "binary" if kind == pa.binary() else "string") for name, kind in _READ))
    return bundles.table(spark).select("data").mapInArrow(unpack, fields)


_READ = [
    ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("refers_to_record", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
]


def _in_lots(records: Iterator[Record], size: int = 256) -> Iterator[list[tuple]]:
    lot = []
    for found in records:
        lot.append(_checked(found))
        if len(lot) == size:
            yield lot
            lot = []
    if lot:
        yield lot


def _checked(found: Record) -> tuple:
    head, kind = found.head, found.head["WARC-Type"]
    digest, length = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")), int(found.http["Content-Length"])
    if kind == "response" and (hashlib.sha1(found.payload).digest() != digest or len(found.payload) != length):
        raise ValueError(f"{head['WARC-Record-ID']}: its payload isn't the one that was stored")
    refers_to = head["WARC-Refers-To"][1:-1] if kind == "revisit" else None
    return head["WARC-Record-ID"][1:-1], kind, head.get("WARC-Target-URI"), refers_to, length, digest.hex(), found.payload if kind == "response" else None


def lookup(spark: SparkSession, bundles: Bundles, wanted: DataFrame) -> DataFrame:
    """`record_id, data` of the wanted record ids: only their frames are decompressed, each once.

    The index picks the bundles; a bundle's wanted records meet it in one row.
    """
    places = bundles.index(spark).join(wanted.select("record_id").distinct(), "record_id", "left_semi")
    places = places.groupBy("bundle").agg(F.sort_array(F.collect_list(F.struct("frame", "offset", "length", "record_id"))).alias("places"))  # of one bundle

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream, 1):
            reader, at, plain = BundleReader(batch.column(0)[0].as_py()), None, b""
            names, out = [], []
            for place in batch.column(1)[0].as_py():
                if place["frame"] != at:
                    at, plain = place["frame"], reader.frame(place["frame"])
                names.append(place["record_id"])
                out.append(plain[place["offset"] : place["offset"] + place["length"]])
            yield record({"record_id": pa.array(names), "data": pa.array(out, pa.binary())})

    return bundles.table(spark).select("bundle", "data").join(places, "bundle").select("data", "places").mapInArrow(cut, "record_id string, data binary")


def archived(pages: DataFrame) -> DataFrame:
    """Writes the pages to a new folder and reads the archives back: `page_id, payload_bytes, payload_digest, record_type,
    refers_to` of every record. Pages are named by the record index; a revisit's response must be there and be equal.
    """
    spark = pages.sparkSession
    bundles = write(pages, new_folder(spark, "warc"))
    found = stored(read(spark, bundles).drop("payload", "url"), "warc-read")
    index = stored(bundles.index(spark).select("record_id", "page_id"), "warc-index")
    found = found.join(index, "record_id")
    first = stored(found.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("n"), F.lit(True).alias("there")), "warc-responses")
    wrong = (F.col("record_type") == "revisit") & (F.col("there").isNull() | (F.col("d") != F.col("payload_digest")) | (F.col("n") != F.col("payload_bytes")))
    kind = F.when(wrong, F.raise_error(F.concat(F.lit("no such response for "), F.col("record_id"))).cast("string")).otherwise(F.col("record_type"))
    return found.join(first, "refers_to_record", "left").select("page_id", "payload_bytes", "payload_digest", kind.alias("record_type"), "refers_to")
