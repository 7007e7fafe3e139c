"""Exact quantiles (linear interpolation) of large groups without holding a group in one task.

``percentile`` keeps every value of a group in one aggregation buffer, which is
fine for a 128-sample window and wrong for a 30 TB column.  Here:

1. one pass takes per group the number of values and, around each target rank,
   a bracket of two approximate quantiles (mergeable sketches), with any further
   aggregates the caller asks for;
2. a second pass turns each row into one count: of its value if that is inside
   a bracket (about ``2 * MARGIN / ACCURACY`` of the rows, one row for a value
   however often it occurs), else of the zone between brackets that it lies in;
3. the zones below a bracket and the ranks inside it give the value at its rank.

No pass shuffles the rows, and far-out values do not matter.  Groups with so
many rows that a bracket may hold more than ``MOST_INSIDE`` values take the full
path, which ranks their distinct values over data-driven ranges.

``q(p) = v[floor(h)] + (v[floor(h)+1] - v[floor(h)]) * (h - floor(h))`` with
``h = p * (n - 1)``, as numpy, Spark ``percentile`` and DuckDB
``quantile_cont`` define it.  NULL and NaN values do not count; NULL groups are
groups; a group without values has no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strideframe.functions.nullsafe import key_columns
from strideframe.functions.ranking import prefix_below
from strideframe.functions.sizing import broadcast_if_small, local_if_small

ACCURACY = 2000
#: width of a bracket on either side of its rank, in errors of the sketch
MARGIN = 3
MOST_INSIDE = 2_000_000


def _targets(n: Column, probs: list[float]) -> Column:
    def one(p: float) -> Column:
        h = F.lit(float(p)) * (n - 1)
        return F.struct(F.lit(float(p)).alias("p"), h.alias("h"), F.floor(h).alias("lo"), F.least(F.floor(h) + 1, n - 1).alias("hi"))

    return F.array(*[one(p) for p in probs])


def _picked(ranked: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys..., p, q`` from distinct values with rank intervals ``[_start, _end)`` and their targets."""
    at = lambda rank: (F.col("_start") <= F.col(rank)) & (F.col(rank) < F.col("_end"))
    found = ranked.groupBy(*keys, "p", "h").agg(F.max(F.when(at("lo"), F.col(value))).alias("_lo"), F.max(F.when(at("hi"), F.col(value))).alias("_hi"))
    frac = F.col("h") - F.floor("h")
    return found.select(*keys, "p", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * frac).alias("q"))


def _by_ranges(rows: DataFrame, keys: list[str], value: str, probs: list[float]) -> DataFrame:
    """The full path: ranks of all distinct values."""
    counts = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    total = counts.groupBy(*keys).agg(F.sum("_c").alias("_n"))
    ranked = prefix_below(counts, keys, value, ["_c"]).join(broadcast_if_small(total), keys)
    ranked = ranked.select(*keys, value, F.col("_c_below").alias("_start"), (F.col("_c_below") + F.col("_c")).alias("_end"), F.inline(_targets(F.col("_n"), probs)))
    hit = ((F.col("_start") <= F.col("lo")) & (F.col("lo") < F.col("_end"))) | ((F.col("_start") <= F.col("hi")) & (F.col("hi") < F.col("_end")))
    return _picked(ranked.where(hit), keys, value)


def _quantiles(long_df: DataFrame, group: list[str], value: str, probs: list[float], also: dict[str, Column]) -> tuple[DataFrame, DataFrame, list[str]]:
    """``keys..., p, q``; a table ``keys..., group..., also...`` of all groups; the keys."""
    probs = sorted(probs)
    keyed, keys = key_columns(long_df, group)
    if not keys:
        keyed, keys = keyed.withColumn("_key0", F.lit(0)), ["_key0"]
    is_nan = F.isnan(F.col(value).cast("double"))
    number = F.when(~is_nan, F.col(value))
    shares = [s for p in probs for s in (max(0.0, p - MARGIN / ACCURACY), min(1.0, p + MARGIN / ACCURACY))]
    named = [F.first(g).alias(g) for g in group if g not in keys]
    sketch = keyed.groupBy(*keys).agg(
        F.count(number).alias("_n"), F.percentile_approx(number, shares, ACCURACY).alias("_b"), *named, *[c.alias(k) for k, c in also.items()]
    )
    sketch, _ = local_if_small(sketch)
    held = sketch.where("_n > 0").select(*keys, "_n", "_b")
    rows = keyed.select(*keys, number.alias(value)).where(F.col(value).isNotNull())
    # few rows: all are inside
    few = F.col("_n") <= 4 * ACCURACY
    low = lambda i: F.when(~few, F.element_at("_b", 2 * i + 1))
    high = lambda i: F.when(~few, F.element_at("_b", 2 * i + 2))
    x = F.col(value)
    many = F.col("_n") * (2 * MARGIN / ACCURACY) > MOST_INSIDE
    inside = few
    zone = F.lit(0)
    for i in range(len(probs)):
        inside = inside | x.between(low(i), high(i))
        zone = zone + F.when(x > high(i), 1).otherwise(0)
    counts = rows.join(held.where(~many), keys).groupBy(*keys, zone.alias("_zone"), F.when(inside, x).alias(value)).agg(F.count(F.lit(1)).alias("_c"))
    targets = F.transform(
        _targets(F.col("_n"), probs),
        lambda t, i: F.struct(t["p"].alias("p"), t["h"].alias("h"), t["lo"].alias("lo"), t["hi"].alias("hi"), i.alias("i"), low(i).alias("low"), high(i).alias("high")),
    )
    each = counts.join(held, keys).select(*keys, value, "_zone", "_c", F.inline(targets))
    # from here on rows are few: a zone below the bracket, or a value, for each target
    below_bracket = F.when(x.isNull(), F.col("_zone") <= F.col("i")).otherwise(x < F.col("low"))
    each = each.withColumn("_below", F.coalesce(below_bracket, F.lit(False)))
    part = each.where(F.col("_below") | (x.isNotNull() & (F.col("high").isNull() | (x <= F.col("high")))))
    part = part.groupBy(*keys, "p", "h", "lo", "hi", F.when(~F.col("_below"), x).alias(value)).agg(F.sum("_c").alias("_c"))
    upto = Window.partitionBy(*keys, "p").orderBy(F.col(value).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = part.withColumn("_end", F.sum("_c").over(upto)).withColumn("_start", F.col("_end") - F.col("_c"))
    found = _picked(ranked.where(F.col(value).isNotNull()), keys, value)
    # the sketch's error is below MARGIN / ACCURACY, so this cannot happen; never return a wrong value silently
    found = found.withColumn("q", F.when(F.col("q").isNull(), F.raise_error(F.lit("a quantile bracket missed its rank")).cast("double")).otherwise(F.col("q")))
    if not held.where(many).isEmpty():
        found = found.unionByName(_by_ranges(rows.join(held.where(many).select(*keys), keys, "left_semi"), keys, value, probs))
    return found, sketch.select(*keys, *[g for g in group if g not in keys], *also), keys


def exact_quantiles(long_df: DataFrame, group: list[str], value: str, probs: list[float]) -> DataFrame:
    """``group..., p, q`` for every group and probability."""
    found, names, keys = _quantiles(long_df.select(*group, value), group, value, probs, {})
    return found.join(names, keys).select(*group, "p", "q")


def quantile_columns(long_df: DataFrame, group: list[str], value: str, probs: dict[str, float], also: dict[str, Column] | None = None) -> DataFrame:
    """Wide form: one column per named probability.

    ``also``: further aggregates by name, taken in the first pass; with them
    groups without values have a row too, with NULL quantiles.
    """
    found, names, keys = _quantiles(long_df, group, value, list(probs.values()), also or {})
    aggs = [F.max(F.when(F.col("p") == F.lit(float(p)), F.col("q"))).alias(name) for name, p in probs.items()]
    wide = found.groupBy(*keys).agg(*aggs)
    return names.join(wide, keys, "left" if also else "inner").select(*group, *(also or {}), *probs)
