"""Time-domain window features.

All features of a window come out of ONE ``groupBy(series, window_id)``:
order-free statistics are native aggregates (partial aggregation on the map
side), order- or range-dependent ones (zero crossings, histogram entropy) work
on the window's samples collected in offset order.  A window holds ``size``
samples, so the collected array is bounded by the window size, never by the
series or the table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ENTROPY_BINS = 10
EPS = 1e-10


def ordered_values(collected: Column, axis: str) -> Column:
    """Values of ``axis`` from an offset-sorted ``array<struct<offset, ...>>``."""
    return F.transform(collected, lambda s: s[axis].cast("double"))


def collect_sorted(axes: list[str]) -> Column:
    """Aggregate: the window's samples as an array sorted by ``offset``."""
    return F.array_sort(F.collect_list(F.struct("offset", *axes)))


def zero_crossing_rate(values: Column, mean: Column | None = None) -> Column:
    """Share of consecutive steps whose sign differs (0 is its own sign); <2 samples gives 0.

    ``values`` must be a materialised array column; with ``mean`` (a column) the
    signal is centred first, for signals that never cross zero.  One O(n) fold.
    """
    n = F.size(values)
    c = mean if mean is not None else F.lit(0.0)
    changes = F.aggregate(
        F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
        F.lit(0),
        lambda acc, i: acc
        + F.when((i < n) & (F.signum(values[i] - c) != F.signum(values[i - 1] - c)), F.lit(1)).otherwise(F.lit(0)),
    )
    return F.when(n < 2, F.lit(0.0)).otherwise(changes / (n - 1))


def entropy_of_sorted(sorted_values: Column, mn: Column, mx: Column, n: Column, bins: int = ENTROPY_BINS) -> Column:
    """T5: ``-sum(p * ln(p + 1e-10))`` over the non-empty of ``bins`` equal-width bins; a constant window is 0.

    Bin of ``v`` = ``least(floor((v - mn) / (mx - mn) * bins), bins - 1)``.  One
    fold over the sorted samples: equal bins stand next to each other, so the
    fold keeps the current bin and its run and adds a term when the bin changes.
    """

    def bin_of(v: Column) -> Column:
        return F.least(F.floor((v - mn) / (mx - mn) * bins), F.lit(bins - 1)).cast("int")

    def term(run: Column) -> Column:
        return F.when(run > 0, (run / n) * F.log(run / n + F.lit(EPS))).otherwise(F.lit(0.0))

    def step(acc: Column, v: Column) -> Column:
        b = bin_of(v)
        same = acc["bin"] == b
        return F.struct(
            b.alias("bin"),
            F.when(same, acc["run"] + 1).otherwise(F.lit(1)).alias("run"),
            F.when(same, acc["sum"]).otherwise(acc["sum"] + term(acc["run"])).alias("sum"),
        )

    start = F.struct(F.lit(-1).alias("bin"), F.lit(0).alias("run"), F.lit(0.0).alias("sum"))
    total = F.aggregate(sorted_values, start, step, lambda acc: -(acc["sum"] + term(acc["run"])))
    return F.when(mx == mn, F.lit(0.0)).otherwise(total)


def axis_aggregates(axis: str) -> list[Column]:
    """T1 and T3 as native (partial/final) aggregates for one axis; median and IQR
    come from the window's sorted samples (``sorted_quantile``)."""
    x = F.col(axis).cast("double")
    return [
        F.avg(x).alias(f"mean_{axis}"),
        F.stddev_pop(x).alias(f"std_{axis}"),
        F.min(x).alias(f"min_{axis}"),
        F.max(x).alias(f"max_{axis}"),
        (F.max(x) - F.min(x)).alias(f"range_{axis}"),
        F.avg(x * x).alias(f"energy_{axis}"),
    ]


def sorted_quantile(sorted_values: Column, n: Column, p: float) -> Column:
    """Linear-interpolation quantile of a sorted array (numpy / Spark ``percentile`` rule):
    ``h = p (n - 1)``, ``v[floor h] + (v[floor h + 1] - v[floor h]) (h - floor h)``."""
    h = F.lit(p) * (n - 1)
    lo = F.floor(h).cast("int")
    hi = F.least(lo + 1, n - 1)
    return sorted_values[lo] + (sorted_values[hi] - sorted_values[lo]) * (h - lo)


def cross_axis_aggregates(axes: list[str]) -> list[Column]:
    """T6 (signal magnitude area) and T7 (row-norm mean and population std)."""
    xs = [F.col(a).cast("double") for a in axes]
    abs_sum = F.abs(xs[0])
    sq_sum = xs[0] * xs[0]
    for c in xs[1:]:
        abs_sum = abs_sum + F.abs(c)
        sq_sum = sq_sum + c * c
    norm = F.sqrt(sq_sum)
    return [
        F.avg(abs_sum / len(axes)).alias("sma"),
        F.avg(norm).alias("magnitude_mean"),
        F.stddev_pop(norm).alias("magnitude_std"),
    ]
