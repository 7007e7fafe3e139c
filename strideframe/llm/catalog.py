"""The queries of this subpackage and, where SQL can express them, their DuckDB twins.

Each query applies one operator with its production parameters to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strideframe.llm import align, bpe, brown, chunks, contamination, infill, langid, lineruns, lzprint, neardup, secrets, toxicity, urlfilter, urlfilter_data

QueryFn = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urlfilter.filter_urls(urlfilter_data.captures(pages), urlfilter_data.entries(pages))


def op2_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.scores(table(spark, sf_dir, "documents"))


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(table(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.report(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.report(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.report(table(spark, sf_dir, "documents"))


def op8_lz_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lzprint.compare_with_next(table(spark, sf_dir, "documents"))


def op9_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(table(spark, sf_dir, "documents"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineruns.digests(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.digests(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def queries() -> dict[str, QueryFn]:
    found = {name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filter": urlfilter_data.oracle_sql(),
        "op11_fill_in_middle": infill.oracle_sql(),
        "op12_line_dedup": lineruns.oracle_sql(),
    }
