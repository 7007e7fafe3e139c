"""Mutual information between a continuous feature and a class by nearest neighbours.

For a row of a class with ``n`` rows, ``r`` is its distance to the ``k``-th
nearest value of its own class (``k`` at most ``n - 1``), and ``m`` counts the
values of all classes nearer than ``r``, itself among them.  The estimate is
``psi(N) + mean psi(k) - mean psi(n) - mean psi(m)``, at least 0, in nats;
classes of one row and missing values take no part.  Values are divided by
their standard deviation and get a tiny normal term from the row id's hash, so
ties are broken the same way on any cluster.

No window holds a whole feature.  Rows are ranked within (feature, class) over
ranges of values, then framed in blocks of ranks, each with a halo of ``k`` rows
of its neighbours.  ``m`` is the difference of two counts "values below a bound";
bounds and values are cut into ranges together and counted by running sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strideframe.functions.cuts import below, cut_table
from strideframe.functions.hashing import hash_normal
from strideframe.functions.nullsafe import join_by, key_columns
from strideframe.functions.ranking import bucketed_rank

NEIGHBOURS = 3
#: ranks of one class that are framed together
BLOCK = 65_536
NOISE = 1e-10
SEED = 42


def digamma(n: Column) -> Column:
    """psi of a whole number from 1: the asymptotic series at ``n + 10``, stepped down."""
    x = (n + 10).cast("double")
    inner = F.lit(1 / 12) - F.lit(1.0) / (x * x) * (F.lit(1 / 120) - F.lit(1.0) / (x * x) * (F.lit(1 / 252) - F.lit(1 / 240) / (x * x)))
    series = F.log(x) - F.lit(0.5) / x - inner / (x * x)
    return series - sum((F.lit(1.0) / (n + i) for i in range(1, 10)), F.lit(1.0) / n)


def jitter(long: DataFrame, row: str, feature: str, value: str, out: str, seed: int = SEED) -> DataFrame:
    """Add ``out``: the value over its feature's standard deviation, and a term of about ``NOISE`` from the row id's hash."""
    number = F.col(value).cast("double")
    usable = long.where(number.isNotNull() & ~F.isnan(number))
    scale = usable.groupBy(feature).agg(F.stddev_pop(number).alias("_sd"), F.avg(F.abs(number)).alias("_size"))
    scale = scale.select(feature, F.when(F.col("_sd") > 0, F.col("_sd")).otherwise(1.0).alias("_sd"), "_size")
    scaled = join_by(usable, scale, [feature])
    name = F.concat(F.col(row).cast("string"), F.lit("|"), F.col(feature).cast("string"))
    noise = F.lit(NOISE) * F.greatest(F.lit(1.0), F.col("_size") / F.col("_sd")) * hash_normal(name, seed)
    return scaled.withColumn(out, number / F.col("_sd") + noise).drop("_sd", "_size")


def neighbour_bounds(rows: DataFrame, row: str, feature: str, label: str, value: str, k: int = NEIGHBOURS, block: int = BLOCK) -> DataFrame:
    """Add ``n`` (rows of the class), ``k`` (neighbours used) and ``low``, ``high``: the open interval of nearer values.

    The bound on the ``k``-th neighbour's side is that neighbour's value itself.
    Classes of one row go.
    """
    block = max(block, 2 * k)
    keyed, keys = key_columns(rows, [feature, label])
    table = cut_table(keyed, keys, value)
    cut = keyed.join(table, keys).withColumn("_range", below(F.col("_cuts"), F.col(value))).drop("_cuts")
    ranked = bucketed_rank(cut, keys, F.col("_range"), [value, row], "_rank", "n").drop("_range").where("n > 1")
    at, place = F.floor(F.col("_rank") / block), F.col("_rank") % block
    blocks = F.array(at, F.when((place < k) & (at > 0), at - 1), F.when(place >= block - k, at + 1))
    framed = ranked.withColumn("_block", F.explode(F.filter(blocks, lambda b: b.isNotNull())))
    order = Window.partitionBy(*keys, "_block").orderBy("_rank")
    x = F.col(value)

    def span(back: int, ahead: int) -> Column:
        """The least interval around a row that reaches ``back`` and ``ahead`` rows, as (radius, low, high)."""
        left = F.lag(value, back).over(order) if back else x
        right = F.lead(value, ahead).over(order) if ahead else x
        far = F.greatest(x - left, right - x)
        low = F.when(x - left >= right - x, left).otherwise(x - far)
        high = F.when(right - x >= x - left, right).otherwise(x + far)
        return F.when(left.isNotNull() & right.isNotNull(), F.struct(far.alias("r"), low.alias("low"), high.alias("high")))

    used = F.least(F.lit(k), F.col("n") - 1)
    best = F.lit(None)
    for kk in range(1, k + 1):
        best = F.when(used == kk, F.least(*[span(a, kk - a) for a in range(kk + 1)])).otherwise(best)
    found = framed.withColumn("_span", best).where(F.col("_block") == at)
    return found.select(row, feature, label, value, "n", used.alias("k"), F.col("_span.low").alias("low"), F.col("_span.high").alias("high"))


def counts_between(rows: DataFrame, row: str, feature: str, value: str, low: str = "low", high: str = "high") -> DataFrame:
    """``feature, row, m``: rows of the feature with ``low < value < high``, plus the row itself where the interval is empty.

    Each row gives one value and two bounds; a range's running sum over values,
    with bounds placed before (high) or after (low) equal values, counts what is
    below each bound.
    """
    keyed, keys = key_columns(rows, [feature])
    table = cut_table(keyed, keys, value)
    # an interval without width holds the values equal to the row's own
    flat = F.col(low) >= F.col(high)
    parts = F.array(
        F.struct(F.col(value).alias("at"), F.lit(1).alias("kind"), F.lit(0).alias("sign")),
        F.struct(F.col(high).alias("at"), F.when(flat, 2).otherwise(0).alias("kind"), F.lit(1).alias("sign")),
        F.struct(F.col(low).alias("at"), F.when(flat, 0).otherwise(2).alias("kind"), F.lit(-1).alias("sign")),
    )
    marks = keyed.select(*keys, feature, row, F.inline(parts)) if feature not in keys else keyed.select(*keys, row, F.inline(parts))
    dealt = marks.join(table, keys).withColumn("_r", below(F.col("_cuts"), F.col("at"))).drop("_cuts")
    is_value = (F.col("kind") == 1).cast("long")
    totals = dealt.groupBy(*keys, "_r").agg(F.sum(is_value).alias("_t"))
    before = Window.partitionBy(*keys).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_r", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_o"))
    inner = Window.partitionBy(*keys, "_r").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = dealt.withColumn("_c", F.sum(is_value).over(inner)).where("sign != 0").join(offsets, [*keys, "_r"])
    return counted.groupBy(*dict.fromkeys([*keys, feature]), row).agg(F.sum(F.col("sign") * (F.col("_c") + F.col("_o"))).alias("m")).select(feature, row, "m")


def neighbour_information(
    long: DataFrame, row: str, feature: str, label: str, value: str, k: int = NEIGHBOURS, seed: int = SEED, block: int = BLOCK
) -> DataFrame:
    """``feature, mi``.  ``row`` identifies a row within a feature; a NULL label is a class of its own."""
    fine = jitter(long.select(row, feature, label, value), row, feature, value, "_x", seed)
    near = neighbour_bounds(fine, row, feature, label, "_x", k, block)
    m = counts_between(near, row, feature, "_x")
    own = near.groupBy(feature).agg(F.count(F.lit(1)).alias("_n"), F.avg(digamma(F.col("k"))).alias("_k"), F.avg(digamma(F.col("n"))).alias("_c"))
    around = m.groupBy(feature).agg(F.avg(digamma(F.col("m"))).alias("_m"))
    mi = digamma(F.col("_n")) + F.col("_k") - F.col("_c") - F.col("_m")
    return join_by(own, around, [feature], broadcast=False).select(feature, F.greatest(F.lit(0.0), mi).alias("mi"))
