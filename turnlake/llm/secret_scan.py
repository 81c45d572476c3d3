"""Secret scan with multipart credential linking.

Three kinds of base spans stand on their own: `assign` (a named secret), `access` (an access identifier) and `hex`. Weak
candidates (`user`: a login name, `key`: a run of just 40 base64 characters, `endpoint`: a URL's host) are reported
only when a part that complements them begins within `SCOPE` code points in the same text: identifiers complete secrets
and endpoints, and secrets complete both.

The scan is one projection over the texts. Places come from the lengths of the matches and of the text between them.
Parts are then rows, and the interval join is an equi-join on text and bin of `SCOPE` code points: matches don't
overlap within a kind, so a bin holds a bounded number of them, and a text with very many parts is spread over its bins.
The join is a semi-join: no pairs are made.

Null texts count as empty. Rows with the same id and text are scanned once and all get the result. Only `doc_id` and
`text` are read. An empty table gives no rows. No Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from turnlake.session import stored

SCOPE = 256

# Kinds in their order, pattern, group whose length counts, least length, most length, role.
KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, None, "secret"),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20, None, "identifier"),
    ("hex", r"[0-9a-f]{24,}", 0, 24, None, "secret"),
    ("user", r"""((?i:username|user|login|client_?id|account))["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)""", 2, 3, None, "identifier"),
    ("key", r"[A-Za-z0-9/+]{40,}", 0, 40, 40, "secret"),
    ("endpoint", r"https?://([A-Za-z0-9.-]+)", 1, 4, None, "endpoint"),
)
BASE = ("assign", "access", "hex")
COMPLEMENTS = {"identifier": ("secret",), "secret": ("identifier", "endpoint"), "endpoint": ("secret",)}


def _lengths(kind: str, pattern: str, group: int) -> Column:
    """For each match its number and the lengths of the text since the match before, of the match and of its value."""
    gaps = F.transform(F.split("text", pattern, -1), F.length)
    values = F.transform(F.regexp_extract_all("text", F.lit(pattern), F.lit(group)), F.length)
    lengths = F.arrays_zip(F.transform(kind, F.length).alias("n"), values.alias("n_value"), gaps.alias("gap"))

    def numbered(x: Column, i: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), i.alias("number"), x["gap"].alias("gap"), x["n"].alias("n"), x["n_value"].alias("n_value"))

    return F.transform(F.slice(lengths, 1, F.size(kind)), numbered)


def parts(docs: DataFrame) -> DataFrame:
    """`row, doc_id, found` for every row: `row` names the id and text, `found` lists all matches of all kinds in the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.hex(F.xxhash64(text)), F.length(text))
    rows = docs.select(name.alias("row"), "doc_id", text.alias("text"))
    for kind, pattern, *_ in KINDS:  # most texts have no match of a kind: one pass over them is all then
        rows = rows.withColumn(kind, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    none = F.array().cast("array<struct<kind:string,number:int,gap:int,n:int,n_value:int>>")
    for kind, pattern, group, *_ in KINDS:
        rows = rows.withColumn(f"{kind}_found", F.when(F.size(kind) > 0, _lengths(kind, pattern, group)).otherwise(none))
    return rows.select("row", "doc_id", F.concat(*(f"{kind}_found" for kind, *_ in KINDS)).alias("found"))


def spans(found: DataFrame) -> DataFrame:
    """`row, kind, start, end, role, base` of all parts that are long enough, from `parts`; equal rows once."""
    rows = found.where(F.size("found") > 0).dropDuplicates(["row"]).select("row", F.explode("found").alias("m")).select("row", "m.*")
    upto = W.partitionBy("row", "kind").orderBy("number")
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(upto).cast("long")).withColumn("start", F.col("end") - F.col("n"))
    enough, role = F.lit(False), F.lit(None).cast("string")
    for kind, _, _, least, most, its in KINDS:
        fits = (F.col("n_value") >= least) & ((F.col("n_value") <= most) if most else F.lit(True))
        enough, role = enough | ((F.col("kind") == kind) & fits), F.when(F.col("kind") == kind, its).otherwise(role)
    return rows.where(enough).select("row", "kind", "start", "end", role.alias("role"), F.col("kind").isin(*BASE).alias("base"))


def linked(parts_found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts that a complementary part begins near to."""
    role = F.col("p.role")
    fits = F.lit(False)
    for mine, others in COMPLEMENTS.items():
        fits = fits | ((role == mine) & F.col("q.role").isin(*others))
    bin_of = F.floor(F.col("start") / scope)
    weak = parts_found.where(~F.col("base")).withColumn("bin", bin_of)
    around = parts_found.select("row", "start", "role", F.explode(F.array(bin_of - 1, bin_of, bin_of + 1)).alias("bin"))
    near = (F.col("p.row") == F.col("q.row")) & (F.col("p.bin") == F.col("q.bin")) & (F.abs(F.col("p.start") - F.col("q.start")) <= scope)
    return weak.alias("p").join(around.alias("q"), near & fits, "left_semi").drop("bin")


def scanned(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """`doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked` for every row."""
    rows = stored(parts(docs), "secret-parts")
    found = stored(spans(rows), "secret-spans")
    rank = F.array_position(F.array(*(F.lit(kind) for kind, *_ in KINDS)), F.col("kind"))
    reported = found.where("base").unionByName(linked(found, scope))
    one = F.struct("start", rank.alias("rank"), "kind", "end", "base")
    texts = reported.groupBy("row").agg(
        F.sort_array(F.collect_list(one)).alias("all"),  # no more than one text's spans
        *(F.count(F.when(F.col("kind") == kind, 1)).alias(f"n_{kind}") for kind in BASE),
    )

    def joined(items: Column) -> Column:
        return F.array_join(F.transform(items, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    base = F.filter("all", lambda x: x["base"])
    texts = texts.select("row", *(f"n_{kind}" for kind in BASE), joined(base).alias("base"), joined(F.col("all")).alias("spans"), (F.size("all") - F.size(base)).alias("n_linked"))
    none = F.lit(0).cast("long")
    return rows.select("row", "doc_id").join(texts, "row", "left").select(
        "doc_id", *(F.coalesce(f"n_{kind}", none).alias(f"n_{kind}") for kind in BASE),
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce(F.col("n_linked").cast("long"), none).alias("n_linked"),
    )
