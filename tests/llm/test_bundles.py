import hashlib
import io
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from turnlake.llm import bundles as op
from turnlake.session import new_folder

PAGES = "page_id long, url string, html string"


def brute(rows):
    out = []
    for i, (page, _, html) in enumerate(rows):
        payload = (html or "").encode()
        same = [(p is not None, p or 0, j, p) for j, (p, _, h) in enumerate(rows) if (h or "").encode() == payload]
        *_, j, first = max(same)
        revisit = len(payload) >= op.SMALL and j != i
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def pages_of(spark, rows):
    return spark.createDataFrame(rows, PAGES).withColumn("row", F.lit("x")).withColumn("payload", F.lit(1))


def awkward(n=120):
    pick = random.Random(3)
    bodies = [None, "", "a", "é" * 499, "é" * 500, "é" * 501, "\r\n\r\nWARC/1.1\r\n" * 90, "x" * 5000, "y" * 999, "y" * 1000]
    urls = [None, "", "http://a/b c", "http://a/%41?ü=1\r\n", "http://a/#t"]
    return [(pick.choice([i, i, i, None, 7]), pick.choice(urls), pick.choice([*bodies, f"<p>{i}</p>" * 300])) for i in range(n)]


def test_equals_brute_force(spark):
    rows = awkward()
    assert sorted((tuple(r) for r in op.archived(pages_of(spark, rows)).collect()), key=str) == brute(rows)


def test_a_third_of_the_rows_have_one_payload_and_no_id(spark):
    rows = [(None, "u", "z" * 2000) if i % 3 == 0 else (i, "u", f"{i}" * 600) for i in range(300)]
    assert sorted((tuple(r) for r in op.archived(pages_of(spark, rows)).collect()), key=str) == brute(rows)


def test_empty_table_and_one_huge_page(spark):
    assert op.archived(spark.createDataFrame([], PAGES)).count() == 0
    rows = [(1, "u", "ab" * 4_000_000), (2, "u", "ab" * 4_000_000), (3, "u", "c")]
    assert sorted((tuple(r) for r in op.archived(pages_of(spark, rows)).collect()), key=str) == brute(rows)


def test_payloads_and_urls_come_back(spark):
    rows = [(i, u, h) for i, (_, u, h) in enumerate(awkward())]
    files = op.write(pages_of(spark, rows), new_folder(spark, "t"), frame=4096, bundle=20_000)
    assert files.table(spark).count() > 5
    found = op.read(spark, files).join(files.index(spark).select("record_id", "page_id"), "record_id").collect()
    for r in found:
        page, url, html = rows[r["page_id"]]
        assert r["url"] == (None if url is None else op.target(url))
        assert r["payload"] == (None if r["record_type"] == "revisit" else (html or "").encode())


def test_frames_are_independent_and_the_file_is_plain_zstandard(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * 200) for i in range(60)]
    files = op.write(pages_of(spark, rows), new_folder(spark, "t"), frame=8192)
    for row in files.table(spark).collect():
        reader, plain = op.BundleReader(row["data"]), b""
        frames = [reader.frame(k) for k in range(len(reader.places))]
        with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(row["data"]), read_across_frames=True) as whole:
            plain = whole.read()
        assert plain == b"".join(frames)
        for r in row["records"]:
            found, end = op.parsed(frames[r["frame"]], r["offset"])
            assert found.head["WARC-Record-ID"] == f"<{r['record_id']}>" and end == r["offset"] + r["length"]


def test_lookup_by_record_id(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * 200) for i in range(60)]
    files = op.write(pages_of(spark, rows), new_folder(spark, "t"), frame=8192, bundle=30_000)
    wanted = files.index(spark).where("page_id % 7 = 0")
    found = {op.parsed(bytes(r["data"]))[0].payload.decode() for r in op.lookup(spark, files, wanted).collect()}
    assert found == {h for i, _, h in rows if i % 7 == 0}


def test_broken_files_are_errors():
    writer = op.BundleWriter()
    writer.add(op.warc_record("response", "urn:x", "u", b"abc", hashlib.sha1(b"abd").digest()))
    data = writer.close()
    with pytest.raises(ValueError, match="isn't the one"):
        op._checked(next(op.BundleReader(data).records()))
    with pytest.raises(ValueError, match="no seek table"):
        op.BundleReader(data[:-1] + b"x")
