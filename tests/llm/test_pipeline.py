import zlib
from pathlib import Path

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm.test_decontamination import brute
from llm.test_simhash import brute_components, brute_fingerprint

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).is_dir(), reason="no test data")


def test_every_stage_works_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    kept, results = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        before, kept = kept, stage(spark, kept, SMALL)
        results[name] = kept.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert kept.columns == docs.columns
        kept = spark.createDataFrame(results[name], kept.schema)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rated = {r["doc_id"] for r in results["quality_classifier"]}
    prints = {i: brute_fingerprint(texts[i]) for i in rated}
    label, first = brute_components(set(prints.values())), {}
    for i in sorted(rated):
        first.setdefault(label[prints[i]], i)
    assert {r["doc_id"] for r in results["simhash_near_dedup"]} == set(first.values()) and len(results["simhash_near_dedup"]) == len(first)
    clean = {i for i in first.values() if not brute(texts[i], items)[-1]}
    assert {r["doc_id"] for r in results["benchmark_decontamination"]} == clean
    mixed = sorted(r["doc_id"] for r in results["source_mixture"])
    assert set(mixed) <= clean and max(mixed.count(i) for i in mixed) <= 3
    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    rows = sorted(results["token_files"], key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == mixed
    for r in rows:
        ids = [*tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 1]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


@pytest.mark.parametrize("n", [0, 1])
def test_awkward_documents_go_through_every_stage(spark, tmp_path, n):
    """Null and repeated ids, null, empty and long texts, repeated rows, columns with clashing names; and an empty table."""
    rows = [
        (None, "no id at all here"), (None, "no id at all here"), (None, "another text without an id"), (None, None), (1, None), (2, ""), (3, " \n"),
        (4, "some plain words of a text"), (4, "some plain words of a text"), (4, "other words under the same id"), (5, "word " * 40_000), (6, "é" * 3000), (7, "short"),
    ]
    columns = "doc_id long, text string, lang string, source string, n_chars long, block string, row string, shard string"
    docs = spark.createDataFrame([(i, t, "en", ["a", None, "b"][k % 3], 1, "x", "y", "z") for k, (i, t) in enumerate(rows * n)], columns)
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(7, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "some benchmark item"), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    kept = spark.read.parquet(f"{folder}/documents.parquet")
    counts = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, kept, folder)
        assert name == corpus_pipeline.STAGES[-1][0] or out.columns == docs.columns
        out.write.parquet(f"{folder}/{k}")
        kept = spark.read.parquet(f"{folder}/{k}")
        counts.append(kept.count())
    assert counts[0] == len(rows) * n
    if n:
        dedup = spark.read.parquet(f"{folder}/1").select("doc_id", "text").collect()
        assert len(dedup) == len(set(dedup)) and {(4, "some plain words of a text"), (None, "no id at all here"), (7, "short")} <= {tuple(r) for r in dedup}
        assert counts[2] == counts[1] and counts[4] == counts[3] > 0
    else:
        assert counts == [0] * 5
    assert corpus_pipeline.run(spark, folder).count() == counts[-1]
