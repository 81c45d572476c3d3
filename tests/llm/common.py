"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing columns."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, start=0, source="s"):
    rows = [(start + i, t, "en", source, len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def rows_of(df, key="doc_id"):
    return {row[key]: row.asDict() for row in df.collect()}
