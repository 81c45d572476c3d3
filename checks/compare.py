"""Run registered queries next to their SQL and compare rows: `python -m checks.compare [sf_dir] [name ...]`."""

from __future__ import annotations

import math
import sys
import time
import traceback
from collections import Counter
from pathlib import Path

import duckdb

from checks.registry import ORACLES, QUERIES
from turnlake.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return int(value)
    return str(value) if value is not None and not isinstance(value, str) else value


def compared(spark, connection, folder: str, name: str) -> tuple[bool, str]:
    frame = QUERIES[name](spark, folder)
    columns = sorted(frame.columns)
    rows = Counter(tuple(_cell(row[c]) for c in columns) for row in frame.collect())
    if name not in ORACLES:
        return sum(rows.values()) > 0, f"{sum(rows.values())} rows, no SQL"
    result = connection.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return False, f"columns {columns} vs {sorted(names)}"
    at = [names.index(c) for c in columns]
    expected = Counter(tuple(_cell(row[i]) for i in at) for row in result.fetchall())
    if rows == expected:
        return True, f"{sum(rows.values())} rows"
    ours, theirs = list((rows - expected).items())[:2], list((expected - rows).items())[:2]
    return False, f"{sum(rows.values())} vs {sum(expected.values())} rows\n   {columns}\n   ours {str(ours)[:700]}\n   sql  {str(theirs)[:700]}"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, connection, bad = local_session("compare", 8), connect(folder), []
    for name in names:
        started = time.time()
        try:
            good, note = compared(spark, connection, folder, name)
        except Exception as error:  # report and go on with the next query
            traceback.print_exc(limit=3) if len(names) == 1 else None
            good, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += [] if good else [name]
        print(f"{'ok ' if good else 'BAD'} {name} {time.time() - started:.1f}s {note}", flush=True)
    print(f"{len(names) - len(bad)} of {len(names)} ok; bad: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
