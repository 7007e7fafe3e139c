"""Window statistics from panes (W2, T1 but the order statistics, T3, T6, T7).

A pane is ``gcd(size, step)`` consecutive samples of a series; every window is a
run of whole panes.  Samples are aggregated once, into mergeable moments of
their pane (count, mean, sum of squared deviations, least, greatest), so what is
shuffled does not depend on the overlap.  Windows combine the moments of their
panes: means by their counts, deviations around the window's own mean, which
keeps the digits that sums of squares would lose.

Panes are framed by ``(series, block of panes)`` with a halo of the panes that a
window beginning in the block still needs, so a long series is spread over many
tasks.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strideframe.functions.nullsafe import key_columns
from strideframe.operators.windows import window_step

#: panes of one series that are framed together
BLOCK = 8192


def signals(axes: list[str]) -> dict[str, Column]:
    """The axes, the mean of their absolute values and the norm of each sample."""
    xs = {a: F.col(a).cast("double") for a in axes}
    each = list(xs.values())
    absolute = sum((F.abs(x) for x in each[1:]), F.abs(each[0])) / len(axes)
    squares = sum((x * x for x in each[1:]), each[0] * each[0])
    return xs | {"abs_": absolute, "norm_": F.sqrt(squares)}


def pane_moments(positioned: DataFrame, key: str, values: dict[str, Column], size: int, overlap: float) -> DataFrame:
    """``key, pane, rows`` and for each value a struct ``n, mean, m2, low, high`` (NULL samples do not count)."""
    width = gcd(size, window_step(size, overlap))
    aggs = [
        F.struct(
            F.count(x).alias("n"),
            F.avg(x).alias("mean"),
            (F.var_pop(x) * F.count(x)).alias("m2"),
            F.min(x).alias("low"),
            F.max(x).alias("high"),
        ).alias(name)
        for name, x in values.items()
    ]
    return positioned.groupBy(key, F.floor(F.col("pos") / width).alias("pane")).agg(F.count(F.lit(1)).alias("rows"), *aggs)


def _combined(parts: Column) -> Column:
    """``n, mean, m2, low, high`` of a window from the structs of its panes."""
    number = lambda get: F.aggregate(parts, F.lit(0.0), lambda acc, p: acc + F.coalesce(get(p), F.lit(0.0)))
    n = number(lambda p: p["n"].cast("double"))
    mean = F.try_divide(number(lambda p: p["n"] * p["mean"]), n)
    return F.struct(
        n.alias("n"),
        mean.alias("mean"),
        parts.alias("parts"),
        F.array_min(F.transform(parts, lambda p: p["low"])).alias("low"),
        F.array_max(F.transform(parts, lambda p: p["high"])).alias("high"),
    )


def _deviations(window: Column) -> Column:
    mean = window["mean"]
    return F.aggregate(
        window["parts"], F.lit(0.0), lambda acc, p: acc + F.coalesce(p["m2"] + p["n"] * (p["mean"] - mean) * (p["mean"] - mean), F.lit(0.0))
    )


def window_moments(panes: DataFrame, key: str, names: list[str], size: int, overlap: float, block: int = BLOCK) -> DataFrame:
    """``key, window_id`` and for each name a struct ``n, mean, var, low, high``: one row for each complete window."""
    step = window_step(size, overlap)
    width = gcd(size, step)
    span, stride = size // width, step // width
    block = max(block, span)
    keyed, keys = key_columns(panes, [key])
    own = F.floor(F.col("pane") / block)
    # a window that begins in the block before still needs this pane
    blocks = F.when((F.col("pane") % block < span - 1) & (own > 0), F.array(own, own - 1)).otherwise(F.array(own))
    placed = keyed.withColumn("_own", own).withColumn("_block", F.explode(blocks))
    ahead = Window.partitionBy(*keys, "_block").orderBy("pane").rowsBetween(0, span - 1)
    framed = placed.select(
        key, "pane", "_own", "_block", F.sum("rows").over(ahead).alias("_rows"), *[F.collect_list(n).over(ahead).alias(n) for n in names]
    )
    complete = framed.filter((F.col("_own") == F.col("_block")) & (F.col("pane") % stride == 0) & (F.col("_rows") == size))
    whole = complete.select(key, (F.col("pane") / stride).cast("long").alias("window_id"), *[_combined(F.col(n)).alias(n) for n in names])
    out = [
        F.struct(
            F.col(f"{n}.n").cast("long").alias("n"),
            F.col(f"{n}.mean").alias("mean"),
            F.try_divide(_deviations(F.col(n)), F.col(f"{n}.n")).alias("var"),
            F.col(f"{n}.low").alias("low"),
            F.col(f"{n}.high").alias("high"),
        ).alias(n)
        for n in names
    ]
    return whole.select(key, "window_id", *out)


def _moments(positioned: DataFrame, key: str, values: dict[str, Column], size: int, overlap: float, block: int) -> DataFrame:
    return window_moments(pane_moments(positioned, key, values, size, overlap), key, list(values), size, overlap, block)


def window_stats(positioned: DataFrame, key: str, axes: list[str], size: int, overlap: float, block: int = BLOCK) -> DataFrame:
    """Mean, population std, min and max of each axis for every window (``positioned`` has ``pos``)."""
    found = _moments(positioned, key, {a: F.col(a).cast("double") for a in axes}, size, overlap, block)
    cols = []
    for a in axes:
        cols += [F.col(f"{a}.mean").alias(f"{a}_mean"), F.sqrt(f"{a}.var").alias(f"{a}_std"), F.col(f"{a}.low").alias(f"{a}_min"), F.col(f"{a}.high").alias(f"{a}_max")]
    return found.select(key, "window_id", *cols)


def window_signals(positioned: DataFrame, key: str, axes: list[str], size: int, overlap: float, block: int = BLOCK) -> DataFrame:
    """T1 without median and IQR, T3, T6 and T7 for every window.

    The mean square (T3's energy) is the variance plus the squared mean.
    """
    found = _moments(positioned, key, signals(axes), size, overlap, block)
    cols = []
    for a in axes:
        mean, var, low, high = (F.col(f"{a}.{x}") for x in ("mean", "var", "low", "high"))
        cols += [mean.alias(f"mean_{a}"), F.sqrt(var).alias(f"std_{a}"), low.alias(f"min_{a}"), high.alias(f"max_{a}")]
        cols += [(high - low).alias(f"range_{a}"), (var + mean * mean).alias(f"energy_{a}")]
    cols += [F.col("abs_.mean").alias("sma"), F.col("norm_.mean").alias("magnitude_mean"), F.sqrt("norm_.var").alias("magnitude_std")]
    return found.select(key, "window_id", *cols)
