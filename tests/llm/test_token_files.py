import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.common import docs_of, no_docs, rows_of
from turnlake.llm import token_files as op
from turnlake.session import new_folder

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " \n\t ", "a\x0bb \x0c c d\x1ce", "Don't we'll I'm's 3,5.4 a.b,c!! <|endoftext|> <| x", "İstanbul ΟΔΟΣ. ΟΔΟΣ, Σ", "é ́x İ K",
    "\U0001f600..:) a\x00b x\r\ny  \t z ", "½, ①. 三!", 'She said "yes"', '"', "naïve, Straße. œuvre; DŽ ǅ", "a-b_c|d #tag $5,", "a b a c", "İ! aİ\\İ&",
]


def texts():
    pick = random.Random(9)
    letters = "abcdefgéüß'.,!|#3 \n"
    return [*ODD, *("".join(pick.choices(letters, k=pick.randrange(400))) for _ in range(60)), "word " * 90_000, "".join(pick.choices(letters, k=100_000))]


def expected(rows):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, {}
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def test_equals_whole_text_encoding(spark):
    made = texts()
    docs = docs_of(spark, made).withColumn("ids", F.lit(3)).withColumn("tie", F.lit("x")).repartition(5)
    right = expected(list(enumerate(made)))
    found = rows_of(op.written(docs, PATH))
    assert {i: (r["start"], r["n_tokens"], r["ids_crc32"]) for i, r in found.items()} == right
    files = op.write(docs, PATH, new_folder(spark, "tokens"), chunk=1000, shard_bytes=100_000)
    assert files.shards(spark).count() > 2 and files.chunks(spark).agg(F.max("n_ids")).first()[0] == 1000
    found = rows_of(op.documents(spark, files))
    assert {i: (r["start"], r["n_tokens"], r["ids_crc32"]) for i, r in found.items()} == right


def test_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(5, "a b"), (5, "a b"), (5, "c"), (None, "d"), (1, None)], "doc_id long, text string")
    rows = op.written(docs, PATH).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 1, 5, 5, 5]
    assert [r["start"] for r in rows] == list(np.cumsum([0] + [r["n_tokens"] for r in rows])[:-1])


def test_empty_table(spark):
    assert op.written(no_docs(spark), PATH).count() == 0


def test_planes_round_trip():
    ids = np.random.default_rng(1).integers(0, 2**32, 5000).astype("<u4")
    assert (op._unplaned(op._planes(ids), len(ids)) == ids).all()
    assert (op._unplaned(op._planes(ids[:1]), 1) == ids[:1]).all()


def test_forgotten_words_are_made_again(monkeypatch):
    monkeypatch.setattr(op, "CACHE", 5)
    encode, plain = op.Encoder(PATH), Tokenizer.from_file(PATH)
    for text in ["one two three four five six", "one seven eight nine ten eleven", "two, one. seven!"] * 3:
        assert list(np.frombuffer(encode(text.encode()), "<u4")) == plain.encode(text, add_special_tokens=False).ids
