"""Reproducible pseudo-randomness from an md5 of ``id:seed``.

``rand()``/``sample()`` depend on partitioning; every random choice in the
library goes through these expressions instead, so a split or an assignment is
the same on any cluster, after any retry, and in the DuckDB oracle:
``(('0x' || substr(md5(id || ':' || seed), 1, 8))::UBIGINT) % 10000``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 10000


def hash32(id_col: Column | str, seed: int | str) -> Column:
    """First 8 hex digits of md5(id:seed) as a non-negative bigint (0 .. 2^32-1)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    digest = F.md5(F.concat(c.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash60(id_col: Column | str, seed: int | str) -> Column:
    """First 15 hex digits of md5(id:seed) as a non-negative bigint (0 .. 2^60-1)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    digest = F.md5(F.concat(c.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def sql_hash60(id_sql: str, seed: int | str) -> str:
    """DuckDB text of ``hash60``."""
    return f"((('0x' || substr(md5(CAST({id_sql} AS VARCHAR) || ':{seed}'), 1, 15))::UBIGINT)::BIGINT)"


def bucket(id_col: Column | str, seed: int | str, buckets: int = BUCKETS) -> Column:
    """hash32 modulo ``buckets`` (10000 by default)."""
    return F.pmod(hash32(id_col, seed), F.lit(buckets))


def unit_uniform(id_col: Column | str, seed: int | str) -> Column:
    """A uniform number in (0, 1) from hash32."""
    return (hash32(id_col, seed) + F.lit(0.5)) / F.lit(float(2**32))


def hash_normal(id_col: Column | str, seed: int | str) -> Column:
    """Standard normal draw by Box-Muller on two independent hash uniforms."""
    u1 = unit_uniform(id_col, f"{seed}a")
    u2 = unit_uniform(id_col, f"{seed}b")
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(6.283185307179586) * u2)


def sql_normal(id_sql: str, seed: int | str) -> str:
    """DuckDB text of ``hash_normal``."""
    u1, u2 = (f"((('0x' || substr(md5({id_sql} || ':{seed}{part}'), 1, 8))::UBIGINT + 0.5) / {float(2**32)!r})" for part in "ab")
    return f"(sqrt(-2.0 * ln({u1})) * cos(6.283185307179586 * {u2}))"


def sql_bucket(id_sql: str, seed: int | str, buckets: int = BUCKETS) -> str:
    """DuckDB text of ``bucket`` for the oracle queries."""
    return f"((('0x' || substr(md5(CAST({id_sql} AS VARCHAR) || ':{seed}'), 1, 8))::UBIGINT) % {buckets})"
