"""Exploratory statistics (A1-A15) as aggregates over long or wide frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strideframe.functions.nullsafe import join_by
from strideframe.functions.quantiles import exact_quantiles, quantile_columns


def unpivot(df: DataFrame, ids: list[str], cols: list[str], name: str = "feature", value: str = "value") -> DataFrame:
    """Wide to long (``stack``), values cast to double; NaN becomes NULL, so it counts as missing."""
    number = lambda c: F.col(c).cast("double")
    return df.select(*ids, *[F.when(~F.isnan(number(c)), number(c)).alias(c) for c in cols]).unpivot(ids, cols, name, value)


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """A1: count per class (descending) and the imbalance ratio max/min over classes."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    all_rows = Window.partitionBy()
    return counts.withColumn(
        "imbalance_ratio", F.max("count").over(all_rows) / F.min("count").over(all_rows)
    ).orderBy(F.desc("count"), label)


def counts_by_split(df: DataFrame, label: str, classes: DataFrame, splits: list[str], split_col: str = "split") -> DataFrame:
    """A2: class x split counts; every dictionary class present, missing counts 0."""
    piv = df.groupBy(label).pivot(split_col, splits).agg(F.count(F.lit(1)))
    return classes.select(label).distinct().join(piv, label, "left").fillna(0, subset=splits)


def distinct_per_class(df: DataFrame, label: str, group: str, approx: bool = False) -> DataFrame:
    """A3: distinct groups per class (``approx`` uses HyperLogLog++ for huge cardinalities)."""
    f = F.approx_count_distinct if approx else F.count_distinct
    return df.groupBy(label).agg(f(group).alias("n_distinct"))


def describe(df: DataFrame, cols: list[str], ids: list[str] | None = None) -> DataFrame:
    """A4: count, mean, sample std, min, exact 25/50/75 %, max per column (two scans)."""
    base = {
        "count": F.count("value"),
        "mean": F.avg("value"),
        "std": F.stddev_samp("value"),
        "min": F.min("value"),
        "max": F.max("value"),
    }
    q = quantile_columns(unpivot(df, ids or [], cols), ["feature"], "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, base)
    return q.select("feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def stats_of_stats(described: DataFrame) -> DataFrame:
    """A5: global min, max, mean of means and mean of stds over a describe table."""
    return described.agg(
        F.min("min").alias("global_min"),
        F.max("max").alias("global_max"),
        F.avg("mean").alias("mean_of_means"),
        F.avg("std").alias("mean_of_stds"),
    )


def multi_stat(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean, sample std, min, max of every column in one partial/final aggregate."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"), F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.agg(*aggs)


def class_histogram(df: DataFrame, label: str, col: str, bins: int = 50) -> DataFrame:
    """Density histogram per class, ``bins`` equal bins over the class's own range."""
    rng = df.groupBy(label).agg(F.min(col).alias("mn"), F.max(col).alias("mx"), F.count(col).alias("n"))
    x = F.col(col)
    b = F.when(F.col("mx") > F.col("mn"), F.least(F.floor((x - F.col("mn")) / (F.col("mx") - F.col("mn")) * bins), F.lit(bins - 1))).otherwise(0)
    width = F.when(F.col("mx") > F.col("mn"), (F.col("mx") - F.col("mn")) / bins).otherwise(F.lit(1.0))
    return (
        join_by(df.where(x.isNotNull()), rng, [label])
        .groupBy(label, b.alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"), F.first("n").alias("n"), F.first(width).alias("width"))
        .select(label, "bin", "count", (F.col("count") / (F.col("n") * F.col("width"))).alias("density"))
    )


def box_stats(df: DataFrame, label: str, col: str) -> DataFrame:
    """Quartiles, whiskers (last values inside 1.5 IQR of the quartiles) and outlier count per class."""
    q = quantile_columns(df.select(label, F.col(col).cast("double").alias(col)), [label], col, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    lo = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    x = F.col(col)
    return (
        join_by(df, q, [label])
        .groupBy(label, "q1", "median", "q3")
        .agg(
            F.min(F.when(x >= lo, x)).alias("whisker_low"),
            F.max(F.when(x <= hi, x)).alias("whisker_high"),
            F.count_if((x < lo) | (x > hi)).alias("n_outliers"),
        )
    )


def class_mean_variance(long: DataFrame, label: str, feature: str, value: str, top: int = 30) -> DataFrame:
    """Per feature, sample variance of the class means; the ``top`` largest."""
    means = long.groupBy(label, feature).agg(F.avg(value).alias("m"))
    return (
        means.groupBy(feature)
        .agg(F.var_samp("m").alias("class_mean_var"))
        .orderBy(F.desc("class_mean_var"), feature)
        .limit(top)
    )


def first_n_per_class(df: DataFrame, label: str, order: str, n: int = 5) -> DataFrame:
    """A10: first ``n`` rows of each class (rank filter, planned as a WindowGroupLimit)."""
    w = Window.partitionBy(label).orderBy(order)
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)


def class_profile(long: DataFrame, label: str, feature: str, value: str) -> DataFrame:
    """Global min-max scaling per feature, then the class mean."""
    mm = long.groupBy(feature).agg(F.min(value).alias("mn"), F.max(value).alias("mx"))
    scaled = join_by(long, mm, [feature]).withColumn(
        "s", F.when(F.col("mx") > F.col("mn"), (F.col(value) - F.col("mn")) / (F.col("mx") - F.col("mn"))).otherwise(F.col(value) - F.col("mn"))
    )
    return scaled.groupBy(label, feature).agg(F.avg("s").alias("profile"))


def dataset_summary(df: DataFrame, label: str, group: str, split_col: str = "split") -> DataFrame:
    """One row: totals, split counts and shares, classes, groups."""
    s = F.col(split_col)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(s == "train").alias("n_train"),
        F.count_if(s == "val").alias("n_val"),
        F.count_if(s == "test").alias("n_test"),
        F.count_distinct(label).alias("n_classes"),
        F.count_distinct(group).alias("n_groups"),
    ).withColumns({f"share_{k}": F.col(f"n_{k}") / F.col("n_rows") for k in ("train", "val", "test")})


def group_difference(long: DataFrame, label: str, a, b, feature: str, value: str, top: int = 10) -> DataFrame:
    """Mean per feature in two groups, absolute difference, the ``top`` largest."""
    m = long.where(F.col(label).isin(a, b)).groupBy(feature).agg(
        F.avg(F.when(F.col(label) == a, F.col(value))).alias("mean_a"),
        F.avg(F.when(F.col(label) == b, F.col(value))).alias("mean_b"),
    )
    return m.withColumn("abs_diff", F.abs(F.col("mean_a") - F.col("mean_b"))).orderBy(F.desc("abs_diff"), feature).limit(top)


__all__ = [
    "unpivot", "class_distribution", "counts_by_split", "distinct_per_class", "describe", "stats_of_stats",
    "multi_stat", "class_histogram", "box_stats", "class_mean_variance", "first_n_per_class", "class_profile",
    "dataset_summary", "group_difference", "exact_quantiles",
]
