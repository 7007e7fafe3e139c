"""Correlation, selection and dimension-reduction queries (C1-C9) on ``embeddings``."""

from __future__ import annotations

from pyspark.sql import functions as F

from strideframe.functions.hashing import sql_normal
from strideframe.operators import correlate as co
from strideframe.operators import information as info
from strideframe.operators.gramian import blocked_correlation
from strideframe.operators.widepca import randomised_pca
from strideframe.operators import naming
from strideframe.plans.catalog import register, with_ctes
from strideframe.plans.derived import SQL_MATRIX_LONG, SQL_NAMED, matrix_long, named_matrix, table
from strideframe.plans.naming import SQL_CATEGORY

# The driver's embedding dimensions are nearly uncorrelated (|r| <= 0.18), so
# the reference's 0.95 would select nothing; 0.1 keeps the operators exercised.
THRESHOLD = 0.1
TOP_K = 10
MI_BINS = 10

SQL_CORR = """corr_m AS (
  SELECT a.pos AS i, b.pos AS j, corr(a.val, b.val) AS r
  FROM matrix_long a JOIN matrix_long b USING (vec_id) GROUP BY a.pos, b.pos)"""


def corr(spark, d):
    return co.correlation_matrix(table(spark, d, "embeddings"), vector_col="embedding")


@register("c1_correlation", with_ctes(SQL_MATRIX_LONG, SQL_CORR) + "SELECT i, j, r FROM corr_m", floats=["r"])
def c1_correlation(spark, d):
    return corr(spark, d)


@register("c1_blocked_correlation", with_ctes(SQL_MATRIX_LONG, SQL_CORR) + "SELECT i, j, r FROM corr_m", floats=["r"])
def c1_blocked_correlation(spark, d):
    """The matrix as wide tables get it: pairs of feature blocks over row batches (here of 24 features)."""
    return blocked_correlation(table(spark, d, "embeddings"), "embedding", features=24)


@register(
    "c2_correlated_pairs",
    with_ctes(SQL_MATRIX_LONG, SQL_CORR) + f"SELECT i, j, r FROM corr_m WHERE i < j AND abs(r) > {THRESHOLD!r}",
    floats=["r"],
)
def c2_correlated_pairs(spark, d):
    return co.correlated_pairs(corr(spark, d), THRESHOLD)


@register(
    "c3_drop_correlated",
    with_ctes(SQL_MATRIX_LONG, SQL_CORR)
    + f"""SELECT DISTINCT pos AS j FROM matrix_long
WHERE pos NOT IN (SELECT j FROM corr_m WHERE i < j AND abs(r) > {THRESHOLD!r})""",
)
def c3_drop_correlated(spark, d):
    feats = matrix_long(spark, d).select(F.col("pos").alias("j")).distinct()
    return co.drop_correlated(feats, corr(spark, d), THRESHOLD)


SQL_ANOVA = """anova AS (
  SELECT pos, ((total - within_sum) / (k - 1)) / (within_sum / (N - k)) AS f_score
  FROM (SELECT pos, var_pop(val) * count(val) AS total, count(val) AS N, count(DISTINCT label) AS k FROM matrix_long GROUP BY pos)
  JOIN (SELECT pos, sum(v * n) AS within_sum FROM (SELECT pos, label, var_pop(val) AS v, count(val) AS n FROM matrix_long GROUP BY pos, label) GROUP BY pos) USING (pos))"""


def anova(spark, d):
    return co.anova_f(matrix_long(spark, d), "pos", "label", "val")


@register("c4_anova_f", with_ctes(SQL_MATRIX_LONG, SQL_ANOVA) + "SELECT pos, f_score FROM anova", floats=["f_score"])
def c4_anova_f(spark, d):
    return anova(spark, d)


@register(
    "c4_select_k_best",
    with_ctes(SQL_MATRIX_LONG, SQL_ANOVA) + f"SELECT pos, f_score FROM anova ORDER BY f_score DESC, pos LIMIT {TOP_K}",
    floats=["f_score"],
)
def c4_select_k_best(spark, d):
    return co.top_k(anova(spark, d), "f_score", TOP_K, "pos")


@register(
    "c5_mutual_information",
    with_ctes(SQL_MATRIX_LONG)
    + f"""SELECT pos, sum(pxy * ln(pxy / (px * py))) AS mi FROM (
  SELECT pos, c / n AS pxy, sum(c) OVER (PARTITION BY pos, bin) / n AS px, sum(c) OVER (PARTITION BY pos, label) / n AS py
  FROM (SELECT pos, bin, label, count(*) AS c, any_value(n) AS n FROM (
          SELECT pos, label, floor((rank() OVER (PARTITION BY pos ORDER BY val) - 1) * {MI_BINS} / count(*) OVER (PARTITION BY pos)) AS bin,
                 count(*) OVER (PARTITION BY pos) AS n
          FROM matrix_long) GROUP BY pos, bin, label))
GROUP BY pos""",
    floats=["mi"],
)
def c5_mutual_information(spark, d):
    return co.binned_mutual_information(matrix_long(spark, d), "pos", "label", "val", MI_BINS)


# brute force: all pairs of a class for the distance to the k-th neighbour, all pairs of a feature for the count
_K = info.NEIGHBOURS


def sql_neighbours(name: str) -> str:
    """CTEs up to ``knn_mi (pos, mi)``; ``name`` is the feature's name as SQL over ``m``."""
    return f"""xs AS (
  SELECT m.vec_id, m.pos, m.label, m.val / s.sd + {info.NOISE!r} * greatest(1.0, s.size / s.sd) * {sql_normal(f"m.vec_id || '|' || {name}", info.SEED)} AS x
  FROM matrix_long m JOIN (SELECT pos, CASE WHEN stddev_pop(val) > 0 THEN stddev_pop(val) ELSE 1.0 END AS sd, avg(abs(val)) AS size FROM matrix_long GROUP BY pos) s USING (pos)),
cls AS (SELECT pos, label, count(*) AS n FROM xs GROUP BY pos, label HAVING count(*) > 1),
near AS (
  SELECT vec_id, pos, n, least({_K}, n - 1) AS k, d AS r
  FROM (SELECT a.vec_id, a.pos, c.n, abs(b.x - a.x) AS d, row_number() OVER (PARTITION BY a.pos, a.vec_id ORDER BY abs(b.x - a.x)) AS o
        FROM xs a JOIN cls c ON a.pos = c.pos AND a.label = c.label JOIN xs b ON a.pos = b.pos AND a.label = b.label AND a.vec_id <> b.vec_id)
  WHERE o = least({_K}, n - 1)),
inside AS (
  SELECT i.vec_id, i.pos, i.n, i.k, count(*) AS m
  FROM near i JOIN xs a ON a.pos = i.pos AND a.vec_id = i.vec_id
  JOIN (SELECT xs.* FROM xs JOIN cls USING (pos, label)) b ON b.pos = i.pos AND abs(b.x - a.x) < i.r GROUP BY ALL),
psi AS (SELECT g AS n, -0.57721566490153286061 + coalesce(sum(1.0 / g) OVER (ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p
        FROM (SELECT unnest(range(1, (SELECT count(DISTINCT vec_id) + 1 FROM matrix_long))) AS g)),
knn_mi AS (
  SELECT pos, greatest(0.0, any_value(pt.p) + avg(pk.p) - avg(pn.p) - avg(pm.p)) AS mi
  FROM inside i JOIN (SELECT pos, count(*) AS total FROM inside GROUP BY pos) t USING (pos)
  JOIN psi pt ON pt.n = t.total JOIN psi pk ON pk.n = i.k JOIN psi pn ON pn.n = i.n JOIN psi pm ON pm.n = i.m GROUP BY pos)"""


SQL_NEIGHBOURS = sql_neighbours("m.pos")


def neighbour_information(spark, d):
    return info.neighbour_information(matrix_long(spark, d), "vec_id", "pos", "label", "val")


@register("c5_neighbour_information", with_ctes(SQL_MATRIX_LONG, SQL_NEIGHBOURS) + "SELECT pos, mi FROM knn_mi", floats=["mi"])
def c5_neighbour_information(spark, d):
    return neighbour_information(spark, d)


@register(
    "c5_select_k_best",
    with_ctes(SQL_MATRIX_LONG, SQL_NEIGHBOURS) + f"SELECT pos, mi FROM knn_mi ORDER BY mi DESC, pos LIMIT {TOP_K}",
    floats=["mi"],
)
def c5_select_k_best(spark, d):
    return co.top_k(neighbour_information(spark, d), "mi", TOP_K, "pos")


@register(
    "c6_apply_selection",
    with_ctes(SQL_MATRIX_LONG, SQL_ANOVA)
    + f"SELECT vec_id, pos, val FROM matrix_long WHERE pos IN (SELECT pos FROM anova ORDER BY f_score DESC, pos LIMIT {TOP_K})",
    floats=["val"],
)
def c6_apply_selection(spark, d):
    chosen = co.top_k(anova(spark, d), "f_score", TOP_K, "pos").select("pos")
    return matrix_long(spark, d).join(chosen, "pos", "left_semi").select("vec_id", "pos", "val")


SQL_PCA = with_ctes(SQL_MATRIX_LONG) + """SELECT count(*) AS n_rows, (SELECT sum(v) FROM (SELECT var_samp(val) AS v FROM matrix_long GROUP BY pos)) AS total_variance,
       true AS centred, true AS ordered, true AS uncorrelated, true AS shares_fit FROM embeddings"""


def _pca_report(e, proj, ratios):
    """PCA by what does not depend on component signs: the projections are centred and uncorrelated, their
    variances fall and are the stated shares of the total variance."""
    total = e.select(F.posexplode("embedding").alias("pos", "val")).groupBy("pos").agg(F.var_samp(F.col("val").cast("double")).alias("v")).agg(F.sum("v").alias("total_variance"))
    s = proj.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.avg(f"pc_{i}").alias(f"m{i}") for i in range(2)],
        *[F.var_samp(f"pc_{i}").alias(f"v{i}") for i in range(2)],
        F.corr("pc_0", "pc_1").alias("r"),
    )
    near = lambda x, y: F.abs(x - y) < 1e-6
    return s.join(F.broadcast(total)).select(
        "n_rows",
        "total_variance",
        (near(F.col("m0"), F.lit(0.0)) & near(F.col("m1"), F.lit(0.0))).alias("centred"),
        (F.col("v0") >= F.col("v1")).alias("ordered"),
        near(F.col("r"), F.lit(0.0)).alias("uncorrelated"),
        (near(F.col("v0") / F.col("total_variance"), F.lit(ratios[0])) & near(F.col("v1") / F.col("total_variance"), F.lit(ratios[1]))).alias("shares_fit"),
    )


@register("c7_pca", SQL_PCA, floats=["total_variance"])
def c7_pca(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    return _pca_report(e, *co.pca(e, "embedding", 2))


@register("c7_randomised_pca", SQL_PCA, floats=["total_variance"])
def c7_randomised_pca(spark, d):
    """PCA as wide vectors get it."""
    e = table(spark, d, "embeddings").select("vec_id", "embedding")
    return _pca_report(e, *randomised_pca(e, "embedding", 2)[:2])


SQL_IMPORTANCE = f"""imp AS (SELECT pos, any_value(name) AS name, var_pop(val) AS importance FROM named GROUP BY pos)"""


def importances(spark, d):
    return named_matrix(spark, d).groupBy("pos").agg(F.first("name").alias("name"), F.var_pop("val").alias("importance"))


@register(
    "c8_importance_ranking",
    with_ctes(SQL_NAMED, SQL_IMPORTANCE) + "SELECT pos, name, importance FROM imp ORDER BY importance DESC, pos LIMIT 20",
    floats=["importance"],
)
def c8_importance_ranking(spark, d):
    return co.importance_ranking(importances(spark, d), "pos", "importance", 20)


@register(
    "c9_importance_by_category",
    with_ctes(SQL_NAMED, SQL_IMPORTANCE) + f"SELECT {SQL_CATEGORY} AS category, sum(importance) AS importance FROM imp GROUP BY 1",
    floats=["importance"],
)
def c9_importance_by_category(spark, d):
    return co.importance_by_category(importances(spark, d), naming.categorize(F.col("name")), "importance")
