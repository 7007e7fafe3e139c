"""Exploratory statistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strideframe.operators import stats
from strideframe.plans import features as feat
from strideframe.plans.catalog import register, with_ctes
from strideframe.plans.derived import SQL_MATRIX_LONG, SQL_TAB, TAB_COLUMNS, matrix_long, tab, table
from strideframe.plans.prep import SQL_SPLIT, split_tab

SPLITS = ["train", "val", "test"]


@register(
    "a1_class_distribution",
    with_ctes(SQL_TAB)
    + """SELECT class, count, CAST(max(count) OVER () AS DOUBLE) / min(count) OVER () AS imbalance_ratio
FROM (SELECT class, count(*) AS count FROM tab GROUP BY class)""",
    floats=["imbalance_ratio"],
)
def a1_class_distribution(spark, d):
    return stats.class_distribution(tab(spark, d), "class")


@register(
    "a2_counts_by_split",
    with_ctes(SQL_TAB, SQL_SPLIT)
    + """SELECT c.class, coalesce(s.train, 0) AS train, coalesce(s.val, 0) AS val, coalesce(s.test, 0) AS test
FROM (SELECT l_returnflag AS class FROM lineitem UNION SELECT o_orderstatus FROM orders) c LEFT JOIN (
  SELECT class, count_if(split = 'train') AS train, count_if(split = 'val') AS val, count_if(split = 'test') AS test
  FROM split GROUP BY class) s USING (class)""",
)
def a2_counts_by_split(spark, d):
    """The dictionary holds order states as well, classes that no row of ``tab`` has."""
    flags = tab(spark, d).select("class")
    states = table(spark, d, "orders").select(F.col("o_orderstatus").alias("class"))
    return stats.counts_by_split(split_tab(spark, d), "class", flags.unionByName(states), SPLITS)


@register(
    "a3_distinct_groups",
    with_ctes(SQL_TAB) + "SELECT class, count(DISTINCT grp) AS n_distinct FROM tab GROUP BY class",
)
def a3_distinct_groups(spark, d):
    return stats.distinct_per_class(tab(spark, d), "class", "grp")


def _sql_describe(source: str, cols: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
       min({c}) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,
       quantile_cont({c}, 0.75) AS p75, max({c}) AS max FROM {source}"""
        for c in cols
    )
    return parts


DESCRIBE_FLOATS = ["mean", "std", "min", "p25", "p50", "p75", "max"]


@register("a4_describe", with_ctes(SQL_TAB) + _sql_describe("tab", TAB_COLUMNS), floats=DESCRIBE_FLOATS)
def a4_describe(spark, d):
    return stats.describe(tab(spark, d), TAB_COLUMNS)


@register(
    "a5_stats_of_stats",
    with_ctes(SQL_TAB, f"dsc AS ({_sql_describe('tab', TAB_COLUMNS)})")
    + "SELECT min(min) AS global_min, max(max) AS global_max, avg(mean) AS mean_of_means, avg(std) AS mean_of_stds FROM dsc",
    floats=["global_min", "global_max", "mean_of_means", "mean_of_stds"],
)
def a5_stats_of_stats(spark, d):
    return stats.stats_of_stats(stats.describe(tab(spark, d), TAB_COLUMNS))


_A6 = [f"{c}_{s}" for c in TAB_COLUMNS for s in ("mean", "std", "min", "max")]


@register(
    "a6_multi_stat",
    with_ctes(SQL_TAB)
    + "SELECT "
    + ", ".join(f"avg({c}) AS {c}_mean, stddev_samp({c}) AS {c}_std, min({c}) AS {c}_min, max({c}) AS {c}_max" for c in TAB_COLUMNS)
    + " FROM tab",
    floats=_A6,
)
def a6_multi_stat(spark, d):
    return stats.multi_stat(tab(spark, d), TAB_COLUMNS)


@register(
    "a7_class_histogram",
    with_ctes(SQL_TAB)
    + """SELECT t.class, CASE WHEN r.mx > r.mn THEN least(floor((t.l_extendedprice - r.mn) / (r.mx - r.mn) * 50), 49) ELSE 0 END AS bin,
       count(*) AS count,
       count(*) / (any_value(r.n) * any_value(CASE WHEN r.mx > r.mn THEN (r.mx - r.mn) / 50 ELSE 1.0 END)) AS density
FROM tab t JOIN (SELECT class, min(l_extendedprice) AS mn, max(l_extendedprice) AS mx, count(l_extendedprice) AS n
                 FROM tab GROUP BY class) r USING (class)
GROUP BY ALL""",
    floats=["density"],
)
def a7_class_histogram(spark, d):
    return stats.class_histogram(tab(spark, d), "class", "l_extendedprice", 50).withColumn("bin", F.col("bin").cast("bigint"))


@register(
    "a8_box_stats",
    with_ctes(
        SQL_TAB,
        """q AS (SELECT class, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
                  quantile_cont(l_extendedprice, 0.75) AS q3 FROM tab GROUP BY class)""",
    )
    + """SELECT class, q1, median, q3,
       min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) THEN x END) AS whisker_low,
       max(CASE WHEN x <= q3 + 1.5 * (q3 - q1) THEN x END) AS whisker_high,
       count_if(x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM (SELECT class, l_extendedprice AS x FROM tab) JOIN q USING (class) GROUP BY class, q1, median, q3""",
    floats=["q1", "median", "q3", "whisker_low", "whisker_high"],
)
def a8_box_stats(spark, d):
    return stats.box_stats(tab(spark, d), "class", "l_extendedprice")


@register(
    "a9_class_mean_variance",
    with_ctes(SQL_MATRIX_LONG)
    + """SELECT pos, var_samp(m) AS class_mean_var FROM (
  SELECT label, pos, avg(val) AS m FROM matrix_long GROUP BY label, pos) GROUP BY pos
ORDER BY class_mean_var DESC, pos LIMIT 30""",
    floats=["class_mean_var"],
)
def a9_class_mean_variance(spark, d):
    return stats.class_mean_variance(matrix_long(spark, d), "label", "pos", "val", 30)


@register(
    "a10_first_per_class",
    with_ctes(SQL_TAB)
    + """SELECT class, row_id, rn FROM (
  SELECT class, row_id, CAST(row_number() OVER (PARTITION BY class ORDER BY row_id) AS INTEGER) AS rn FROM tab) WHERE rn <= 5""",
)
def a10_first_per_class(spark, d):
    return stats.first_n_per_class(tab(spark, d), "class", "row_id", 5).select("class", "row_id", "rn")


@register(
    "a11_class_profile",
    with_ctes(SQL_MATRIX_LONG)
    + """SELECT label, pos, avg(CASE WHEN mx > mn THEN (val - mn) / (mx - mn) ELSE val - mn END) AS profile
FROM matrix_long JOIN (SELECT pos, min(val) AS mn, max(val) AS mx FROM matrix_long GROUP BY pos) USING (pos)
GROUP BY label, pos""",
    floats=["profile"],
)
def a11_class_profile(spark, d):
    return stats.class_profile(matrix_long(spark, d), "label", "pos", "val")


@register(
    "a12_dataset_summary",
    with_ctes(SQL_TAB, SQL_SPLIT)
    + """SELECT n_rows, n_train, n_val, n_test, n_classes, n_groups,
       n_train / n_rows AS share_train, n_val / n_rows AS share_val, n_test / n_rows AS share_test
FROM (SELECT count(*) AS n_rows, count_if(split = 'train') AS n_train, count_if(split = 'val') AS n_val,
             count_if(split = 'test') AS n_test, count(DISTINCT class) AS n_classes, count(DISTINCT grp) AS n_groups
      FROM split)""",
    floats=["share_train", "share_val", "share_test"],
)
def a12_dataset_summary(spark, d):
    return stats.dataset_summary(split_tab(spark, d), "class", "grp")


@register(
    "a13_split_union",
    with_ctes(SQL_TAB, SQL_SPLIT)
    + """SELECT row_id, grp, class, 'train' AS source FROM split WHERE split = 'train'
UNION ALL SELECT row_id, grp, class, 'test' AS source FROM split WHERE split <> 'train'""",
)
def a13_split_union(spark, d):
    s = split_tab(spark, d).select("row_id", "grp", "class", "split")
    return s.select("row_id", "grp", "class", F.when(F.col("split") == "train", "train").otherwise("test").alias("source"))


@register(
    "a14_group_difference",
    with_ctes(SQL_MATRIX_LONG)
    + """SELECT pos, mean_a, mean_b, abs(mean_a - mean_b) AS abs_diff FROM (
  SELECT pos, avg(CASE WHEN label = 0 THEN val END) AS mean_a, avg(CASE WHEN label = 1 THEN val END) AS mean_b
  FROM matrix_long WHERE label IN (0, 1) GROUP BY pos)
ORDER BY abs_diff DESC, pos LIMIT 10""",
    floats=["mean_a", "mean_b", "abs_diff"],
)
def a14_group_difference(spark, d):
    return stats.group_difference(matrix_long(spark, d), "label", 0, 1, "pos", "val", 10)


A15_COLS = ["mean_x", "std_x", "entropy_x", "dominant_freq_x", "spectral_entropy_x", "sma"]


@register(
    "a15_feature_summary",
    f"WITH f7 AS ({feat._sql_full(True, True, False, A15_COLS)})\n" + _sql_describe("f7", A15_COLS),
    floats=DESCRIBE_FLOATS,
)
def a15_feature_summary(spark, d):
    return stats.describe(feat.features(spark, d, True, True, False).select(*A15_COLS), A15_COLS)
