"""The corpus pipeline: documents in, tokenised clean documents out.

``STAGES`` are applied in order; each reads what its predecessor wrote.  All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.llm import bpe, catalog, contamination, langid, neardup, secrets
from strideframe.session import checkpoint_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected stay.

    Null, empty and letterless texts have no language and go.  Learns from the
    rows that name a language; if none does, all documents stay.
    """
    model = langid.fit(docs)
    if model is None:
        return docs.select(*COLUMNS)
    return langid.identify(docs.select(*COLUMNS), model).filter("not lang_rejected").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays; those without words are in a class with equal texts only, null and empty ones alone."""
    return neardup.keep_one(docs.select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item stay; a null text holds none."""
    return contamination.keep_clean(spark, docs, catalog.table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; found secrets are replaced by a mark, and ``n_chars`` follows the text (a null text stays null)."""
    masked = secrets.redact(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, with language, source and the digest of the decoded text."""
    coded = bpe.encode(docs.select(*COLUMNS), catalog.tokenizer_path(), as_array=True, cache_words=30_000, slice_bytes=2 << 20)
    digest = F.sha2(F.col("bpe_text").cast("binary"), 256).alias("decoded_sha256")
    return coded.select("doc_id", "lang", "source", F.col("bpe_n").alias("n_tokens"), digest, F.col("bpe_ids").alias("ids"))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("secret_scan", mask_secrets),
    ("bpe", tokenise),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written under the checkpoint folder and read again."""
    import uuid

    base = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = catalog.table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
