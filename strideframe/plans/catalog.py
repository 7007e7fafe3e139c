"""Registry of the library's checked queries: a Spark plan and its DuckDB oracle.

``register(name, sql=..., floats=..., bits=...)`` decorates a ``(spark, sf_dir)
-> DataFrame`` function.  On both sides floating columns are rounded the same
way because sums in a different order differ in the last bits.  The grid is
binary, ``round(x * 2^k) / 2^k`` with ``k = 20`` (about 1e-6) unless a column
lists its own ``k``: scaling by a power of two is exact in both engines and both
round halves away from zero, and a binary grid does not put decimal inputs
(prices with two decimals, averages over 16 samples) exactly on a rounding
boundary the way decimal places do.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    floats: list[str] = field(default_factory=list)
    bits: dict[str, int] = field(default_factory=dict)
    default_bits: int = 20

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_floats(self.fn(spark, sf_dir), self.bits, self.default_bits)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        body = self.sql.strip()
        if not self.floats:
            return body
        repl = ", ".join(sql_round(c, c, self.bits.get(c, self.default_bits)) for c in self.floats)
        return f"SELECT * REPLACE ({repl}) FROM (\n{body}\n) AS oracle_q"


REGISTRY: dict[str, Query] = {}


def register(
    name: str,
    sql: str | None = None,
    floats: list[str] | None = None,
    bits: dict[str, int] | None = None,
    default_bits: int = 20,
):
    """Register a query; ``floats`` are the oracle's floating columns, rounded like Spark's."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(name, fn, sql, list(floats or []), dict(bits or {}), default_bits)
        return fn

    return deco


def round_floats(df: DataFrame, bits: dict[str, int] | None = None, default: int = 20) -> DataFrame:
    """Round every float/double column to a grid of ``2^-k`` (``bits`` overrides ``k`` per column)."""
    bits = bits or {}
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            scale = float(2 ** bits.get(f.name, default))
            cols.append((F.round(F.col(f.name).cast("double") * scale) / scale).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def sql_round(expr: str, name: str, bits: int = 20) -> str:
    scale = float(2**bits)
    return f"round(CAST({expr} AS DOUBLE) * {scale}) / {scale} AS {name}"


def with_ctes(*ctes: str) -> str:
    """``WITH a AS (...), b AS (...)`` from CTE texts."""
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def all_queries() -> dict[str, Query]:
    # importing the plan modules fills the registry
    from strideframe.plans import (  # noqa: F401
        evaluation,
        experiments,
        features,
        models,
        naming,
        prep,
        quality,
        runlogs,
        scans,
        selection,
        stats,
        streams,
    )

    return dict(REGISTRY)
