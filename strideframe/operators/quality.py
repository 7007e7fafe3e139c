"""Data-quality checks (V1-V4): one aggregate per check, results as small tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rule_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """V1: ``rule, n_rows, n_violations, ok`` for boolean rules that must hold on every row.

    All rules are counted in ONE pass (``count_if`` per rule), then unpivoted.
    A NULL rule result counts as a violation.
    """
    aggs = [F.count(F.lit(1)).alias("n_rows")] + [
        F.count_if(~F.coalesce(c, F.lit(False))).alias(f"v_{i}") for i, c in enumerate(rules.values())
    ]
    one = df.agg(*aggs)
    stacked = one.select(
        "n_rows",
        F.inline(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"v_{i}").alias("n_violations")) for i, r in enumerate(rules)])),
    )
    return stacked.select("rule", "n_rows", "n_violations", (F.col("n_violations") == 0).alias("ok"))


def null_report(df: DataFrame, cols: list[str], expected_width: int | None = None) -> DataFrame:
    """V2: NULL or NaN count per column in one aggregate; optional exact width check (driver side)."""
    if expected_width is not None and len(df.columns) != expected_width:
        raise ValueError(f"expected {expected_width} columns, got {len(df.columns)}")
    types = dict(df.dtypes)

    def bad(c):
        x = F.col(c)
        return x.isNull() | F.isnan(x) if types[c] in ("double", "float") else x.isNull()

    one = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(bad(c)).alias(f"n_{i}") for i, c in enumerate(cols)])
    return one.select(
        "n_rows",
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n_{i}").alias("n_null")) for i, c in enumerate(cols)])),
    ).select("column", "n_rows", "n_null")


def coercion_report(df: DataFrame, casts: dict[str, tuple[Column, str]]) -> DataFrame:
    """V3: for ``name -> (expr, type)``: non-null inputs and values lost by ``try_cast``."""
    src = df.select(*[expr.alias(f"__c{i}") for i, (expr, _) in enumerate(casts.values())])
    aggs = []
    for i, (name, (_, typ)) in enumerate(casts.items()):
        c = F.col(f"__c{i}")
        aggs += [
            F.count(c).alias(f"in_{i}"),
            F.count_if(c.isNotNull() & F.expr(f"try_cast(`__c{i}` AS {typ})").isNull()).alias(f"lost_{i}"),
        ]
    one = src.agg(*aggs)
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("column"), F.col(f"in_{i}").alias("n_input"), F.col(f"lost_{i}").alias("n_lost"))
                    for i, n in enumerate(casts)
                ]
            )
        )
    )


def coerce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """V3: cast declared columns with ``try_cast``; undeclared extra columns pass through."""
    declared = {f.name: f.dataType.simpleString() for f in schema.fields}
    return df.select(
        *[F.expr(f"try_cast(`{c}` AS {declared[c]})").alias(c) if c in declared else F.col(c) for c in df.columns]
    )


def vector_requests(df: DataFrame, vec: str, width: int) -> DataFrame:
    """V4: split requests into ``ok`` and ``rejected`` with a reason (empty or wrong width)."""
    n = F.size(F.col(vec))
    reason = F.when(F.col(vec).isNull() | (n == 0), "empty").when(n != width, "wrong_width")
    return df.withColumn("reason", reason).withColumn("status", F.when(F.col("reason").isNull(), "ok").otherwise("rejected"))
