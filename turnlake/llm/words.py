"""Helpers that several operators share: words of raw bytes, schemas and row streams in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing A-Z stay, all others become a space.
_PLAIN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def plain_words(text: bytes) -> list[bytes]:
    """Words of digits, lower-cased ASCII letters and non-ASCII characters."""
    return text.translate(_PLAIN).split()


def space_words(text: bytes) -> list[bytes]:
    r"""Words `[^\x20\x09-\x0D]+` with A-Z lower-cased; bytes.split() divides at exactly these six characters."""
    return text.lower().split()


def text_bytes(name: str = "text") -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def id_type(docs: DataFrame, name: str = "doc_id") -> T.DataType:
    return docs.schema[name].dataType


def schema(*fields: tuple[str, T.DataType | str]) -> T.StructType:
    out = T.StructType()
    for name, kind in fields:
        out.add(name, T.DataType.fromDDL(kind) if isinstance(kind, str) else kind)
    return out


def batches(stream: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows`."""
    for batch in stream:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def record(arrays: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that the table doesn't have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name
