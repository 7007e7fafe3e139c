"""Cut points from the data: ranges of about equal numbers of rows, whatever the values' distribution.

Equal-width ranges put nearly all rows in one range when a value lies far out.
Here each group's cut points are its approximate quantiles (a mergeable sketch,
one small row per group), and a row's range is found by binary search in them.
The ranges only spread the work; results do not depend on where the cuts fall.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideframe.functions.sizing import local_if_small

MAX_RANGES = 4096
#: rows of a range that one task handles at ease; groups get as many ranges as they need
ROWS_PER_RANGE = 200_000


def below(cuts: Column, value: Column, most: int = MAX_RANGES) -> Column:
    """How many of the ascending ``cuts`` (an array, up to ``most``) are at most ``value``: binary search."""
    steps = [1 << i for i in range(most.bit_length(), -1, -1)]
    size = F.size(cuts)

    def narrow(at: Column, step: Column) -> Column:
        return F.when((at + step <= size) & (F.try_element_at(cuts, at + step) <= value), at + step).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), narrow)


def cut_table(df: DataFrame, group: list[str], value: str, rows_per_range: int | None = None) -> DataFrame:
    """``group..., _cuts``: ascending cut points of each group, one fewer than its ranges.

    The groups are counted first: the largest decides how many ranges the
    sketch has to tell apart, and a group that fits one range has no cuts.
    """
    per = rows_per_range or ROWS_PER_RANGE
    counts, _ = local_if_small(df.groupBy(*group).agg(F.count(value).alias("_rows")))
    largest = counts.agg(F.max("_rows")).first()[0] or 0
    most = min(MAX_RANGES, -(-largest // per))
    if most <= 1:
        return counts.select(*group, F.array().cast("array<double>").alias("_cuts"))
    shares = [i / most for i in range(1, most)]
    sketch = df.groupBy(*group).agg(F.percentile_approx(value, shares, 4 * most).alias("_all"), F.count(value).alias("_rows"))
    ranges = F.least(F.ceil(F.col("_rows") / F.lit(per)), F.lit(most)).cast("int")
    step = F.floor(F.lit(most) / F.greatest(ranges, F.lit(1))).cast("int")
    picked = F.transform(F.sequence(step, F.lit(most - 1), step), lambda i: F.element_at("_all", i))
    none = F.slice("_all", 1, 0)
    cuts, _ = local_if_small(sketch.select(*group, F.when(ranges > 1, F.array_distinct(picked)).otherwise(none).alias("_cuts")))
    return cuts
