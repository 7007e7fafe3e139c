"""Skew-safe exact ``row_number`` within groups.

``row_number() over (partition by g order by o)`` evaluates a whole group in one
task.  When the ordering key can be cut into ranges (a time bucket, the high
bits of a hash), the rank is computed in three steps that keep every task
bounded by a range instead of a group:

1. local rank within ``(g, range)`` (one shuffle of the rows);
2. row counts per ``(g, range)`` (map-side combined, one row per range) and
   their running sum per group, over that small table;
3. the offsets join back on ``(g, range)``; the rows are already partitioned by
   that key, so only the small side moves.

Rows with a NULL group key form a group of their own.  The result equals
``row_number() - 1`` over the group ordered by
``(range, order...)``; when ``range`` is monotone in the first order column,
that is the plain ordering.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strideframe.functions.cuts import below, cut_table
from strideframe.functions.nullsafe import key_columns


def bucketed_rank(
    df: DataFrame,
    group: list[str],
    range_col: Column,
    order: list[str | Column],
    rank_name: str = "rank",
    size_name: str | None = None,
) -> DataFrame:
    """Add a 0-based ``rank_name`` (and optionally the group size) using range cuts."""
    r = "_rank_range"
    keyed, keys = key_columns(df, group)
    # rows without an order value come first, as they do in an ascending order
    rows = keyed.withColumn(r, F.coalesce(range_col.cast("bigint"), F.lit(-(2**62))))
    parts = [*keys, r]
    in_range = Window.partitionBy(*parts)
    local = rows.withColumn("_local", F.row_number().over(in_range.orderBy(*order)) - 1).withColumn(
        "_cnt", F.count(F.lit(1)).over(in_range)
    )
    # one row per range, taken from the ranked rows: the input is scanned,
    # projected and shuffled once (the exchange is reused by both branches)
    counts = local.where(F.col("_local") == 0).select(*parts, "_cnt")
    per_group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    cols = [
        *parts,
        F.coalesce(
            F.sum("_cnt").over(per_group.orderBy(r).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_off"),
    ]
    if size_name:
        cols.append(F.sum("_cnt").over(per_group).cast("bigint").alias(size_name))
    offsets = counts.select(*cols)
    return (
        local.join(offsets, parts, "inner")
        .withColumn(rank_name, (F.col("_off") + F.col("_local")).cast("bigint"))
        .drop(*[k for k in keys if k not in df.columns], r, "_local", "_off", "_cnt")
    )


def hash_range(hash_col: Column, bits: int = 12) -> Column:
    """Top ``bits`` bits of a 32-bit hash value: ``2^bits`` equal ranges."""
    return F.shiftright(hash_col, 32 - bits)


def prefix_below(df: DataFrame, group: list[str], order: str, values: list[str], rows_per_range: int | None = None) -> DataFrame:
    """For rows with DISTINCT ``order`` values per group, add ``<v>_below``: the sum of
    ``v`` over the group's rows with a smaller ``order``.

    The rows of each group are cut into ranges of about equal size by the
    group's approximate quantiles; range totals are summed over a small table
    and a running sum inside ``(group, range)`` finishes the job, so a group's
    rows are spread over its ranges however its values lie.
    """
    keyed, keys = key_columns(df, group)
    if not keys:
        keyed, keys = keyed.withColumn("_key0", F.lit(0)), ["_key0"]
    table = cut_table(keyed, keys, order, rows_per_range=rows_per_range)
    rows = keyed.join(table, keys).withColumn("_r", below(F.col("_cuts"), F.col(order))).drop("_cuts")
    parts = [*keys, "_r"]
    totals = rows.groupBy(*parts).agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    before = Window.partitionBy(*keys).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*parts, *[F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"_o_{v}") for v in values])
    inner = Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.join(offsets, parts)
    for v in values:
        out = out.withColumn(f"{v}_below", F.col(f"_o_{v}") + F.coalesce(F.sum(v).over(inner), F.lit(0)))
    return out.drop(*[k for k in keys if k not in df.columns], "_r", *[f"_o_{v}" for v in values])


def row_before(df: DataFrame, group: list[str], order: str, values: list[str], rows_per_range: int | None = None) -> DataFrame:
    """For rows with DISTINCT ``order`` values per group, add ``<v>_before``: ``v`` of the group's row with
    the next smaller ``order`` (NULL for the least).

    Inside a range that is a ``lag``; the first row of a range takes it from the
    greatest row of the range before, out of a table with one row for each range.
    """
    keyed, keys = key_columns(df, group)
    if not keys:
        keyed, keys = keyed.withColumn("_key0", F.lit(0)), ["_key0"]
    table = cut_table(keyed, keys, order, rows_per_range=rows_per_range)
    rows = keyed.join(table, keys).withColumn("_r", below(F.col("_cuts"), F.col(order))).drop("_cuts")
    parts = [*keys, "_r"]
    last = rows.groupBy(*parts).agg(F.max_by(F.struct(*values), order).alias("_last"))
    halo = last.withColumn("_last", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_r")))
    inner = Window.partitionBy(*parts).orderBy(order)
    placed = rows.withColumn("_own", F.lag(F.struct(*values)).over(inner)).join(halo, parts)
    before = F.coalesce(F.col("_own"), F.col("_last"))
    out = placed.withColumns({f"{v}_before": before[v] for v in values})
    return out.drop(*[k for k in keys if k not in df.columns], "_r", "_own", "_last")
