"""Small tables and comparisons shared by the tests of this folder."""

from pyspark.sql import functions as F

EDGE_TEXTS = [
    None,
    "",
    "   \n\t ",
    "a",
    "Ünï cödé ñ 日本語 🙂 text",
    "word " * 30_000,
    "same text twice over and over again until the end of it",
    "same text twice over and over again until the end of it",
    "!!! ... ???",
]


def edge_docs(spark, texts=EDGE_TEXTS):
    """Null ids, null texts, repeated ids and rows, further columns with clashing names."""
    rows = [(i, t, "en" if i % 2 else None, None, len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, "a null id", None, None, None), (6, EDGE_TEXTS[6], "en", "s", 1), (6, EDGE_TEXTS[6], "en", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(c) for c in ("row_", "score", "n_words", "hits", "items", "class_id", "bpe_n", "secret_spans")})


def empty_docs(spark):
    return edge_docs(spark).limit(0)


def documents(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")


def by_id(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}
