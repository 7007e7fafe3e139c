"""Correlation, feature selection and dimension reduction.

The correlation matrix of ``d`` features is ONE distributed Gramian pass
(``pyspark.ml.stat.Correlation``: a tree aggregate of ``d x d`` partial sums),
whose ``d x d`` result is schema-sized, not data-sized.  Univariate scores
(ANOVA F, binned mutual information) are grouped counts and sums over the long
``(row, feature, value)`` form.
"""

from __future__ import annotations

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strideframe.functions.nullsafe import join_by
from strideframe.functions.ranking import prefix_below
from strideframe.functions.sizing import local_if_small
from strideframe.operators.gramian import blocked_correlation
from strideframe.operators.widepca import randomised_pca

#: features whose correlation matrix the driver takes as a whole (32 MB)
DENSE = 2000


def correlation_matrix(df: DataFrame, vector_col: str | None = None, cols: list[str] | None = None) -> DataFrame:
    """Pearson matrix as ``i, j, r`` (feature indices); a constant feature gives NaN.

    Up to ``DENSE`` features the matrix is one aggregate, whose result one
    process holds; wider ones are computed by blocks and stay distributed.
    """
    width = len(cols) if cols is not None else df.select(F.max(F.size(vector_col))).first()[0] or 0
    if width > DENSE:
        vectors = df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("_v")) if cols is not None else df.select(F.col(vector_col).alias("_v"))
        return blocked_correlation(vectors, "_v")
    if vector_col is None:
        vec = VectorAssembler(inputCols=cols, outputCol="_v", handleInvalid="keep").transform(df).select("_v")
    else:
        vec = df.select(array_to_vector(F.col(vector_col)).alias("_v"))
    m = Correlation.corr(vec, "_v", "pearson").head()[0].toArray()
    d = m.shape[0]
    rows = [(i, j, float(m[i, j])) for i in range(d) for j in range(d)]
    return df.sparkSession.createDataFrame(rows, "i int, j int, r double")


def correlated_pairs(corr: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Pairs ``i < j`` with ``|r| > threshold`` (NaN never qualifies)."""
    return corr.where((F.col("i") < F.col("j")) & ~F.isnan("r") & (F.abs("r") > threshold))


def drop_correlated(features: DataFrame, corr: DataFrame, threshold: float = 0.95, key: str = "j") -> DataFrame:
    """Drop feature ``j`` when ANY ``i < j`` has ``|r| > threshold`` (whether or not ``i`` was dropped)."""
    dropped = correlated_pairs(corr, threshold).select(F.col("j").alias(key)).distinct()
    return features.join(dropped, key, "left_anti")


def anova_f(long: DataFrame, feature: str, label: str, value: str) -> DataFrame:
    """C4: one-way ANOVA F per feature, from each class's count, mean and central second moment.

    Values are taken relative to their feature's mean (a first, small aggregate),
    so a large common offset costs no digits.
    """
    centre, _ = local_if_small(long.groupBy(feature).agg(F.avg(value).alias("_centre")))
    off = F.col(value) - F.col("_centre")
    moved = join_by(long, centre, [feature], broadcast=False).withColumn("_off", off)
    g = moved.groupBy(feature, label).agg(F.count("_off").alias("n"), F.avg("_off").alias("m"), F.var_pop("_off").alias("v"))
    each = Window.partitionBy(feature)
    grand = F.sum(F.col("n") * F.col("m")).over(each) / F.sum("n").over(each)
    t = g.withColumn("_d", F.col("m") - grand).groupBy(feature).agg(
        F.sum("n").alias("N"),
        F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n") * F.col("_d") * F.col("_d")).alias("ssb"),
        F.sum(F.col("n") * F.col("v")).alias("ssw"),
    )
    return t.select(
        feature,
        F.try_divide(F.col("ssb") / (F.col("k") - 1), F.col("ssw") / (F.col("N") - F.col("k"))).alias("f_score"),
    )


def top_k(scores: DataFrame, score: str, k: int, tie: str) -> DataFrame:
    """Select-k-best: the ``k`` largest scores (ties by ``tie``); a bounded top-k."""
    return scores.orderBy(F.desc_nulls_last(score), tie).limit(k)


def binned_mutual_information(long: DataFrame, feature: str, label: str, value: str, bins: int = 10) -> DataFrame:
    """C5 (re-aimed): mutual information (nats) between equal-frequency bins of a feature and the class.

    Equal values share a bin: the bin of a value is ``floor(r * bins / n)`` where
    ``r`` is the number of smaller values.  Rows are counted by ``(feature, value,
    label)`` before anything moves, so a value that fills a third of the rows is
    one row for each label; ranks come from data-driven ranges.
    """
    counts = long.where(F.col(value).isNotNull()).groupBy(feature, value, label).agg(F.count(F.lit(1)).alias("c"))
    distinct = counts.groupBy(feature, value).agg(F.sum("c").alias("_c"))
    total = counts.groupBy(feature).agg(F.sum("c").alias("n"))
    ranked = join_by(prefix_below(distinct, [feature], value, ["_c"]), total, [feature])
    bins_of = ranked.select(feature, value, "n", F.floor(F.col("_c_below") * bins / F.col("n")).alias("bin"))
    # NULL labels are a class of their own; values are not NULL here
    joint = counts.join(bins_of, [feature, value]).groupBy(feature, "bin", label).agg(F.sum("c").alias("c"), F.first("n").alias("n"))
    wb = Window.partitionBy(feature, "bin")
    wc = Window.partitionBy(feature, label)
    terms = joint.select(
        feature,
        (F.col("c") / F.col("n")).alias("pxy"),
        (F.sum("c").over(wb) / F.col("n")).alias("px"),
        (F.sum("c").over(wc) / F.col("n")).alias("py"),
    )
    return terms.groupBy(feature).agg(F.sum(F.col("pxy") * F.log(F.col("pxy") / (F.col("px") * F.col("py")))).alias("mi"))


def pca(df: DataFrame, vector_col: str, k: int = 2):
    """PCA on mean-centred vectors (Spark's PCA projects without centring).

    Returns ``(projected frame with pc_0..pc_{k-1}, explained variance ratios)``.
    Component signs are arbitrary.  Vectors of more than ``DENSE`` values go
    through the randomised form, which needs no square matrix.
    """
    if (df.select(F.max(F.size(vector_col))).first()[0] or 0) > DENSE:
        return randomised_pca(df, vector_col, k)[:2]
    vec = df.withColumn("_v", array_to_vector(F.col(vector_col)))
    d = len(df.select(vector_col).head()[0])
    means = vec.select(vector_to_array("_v").alias("_a")).agg(
        F.array(*[F.avg(F.col("_a")[i]) for i in range(d)]).alias("mu")
    ).head()["mu"]
    centred = vec.withColumn(
        "_c", array_to_vector(F.transform(vector_to_array("_v"), lambda x, i: x - F.element_at(F.array(*[F.lit(m) for m in means]), i + 1)))
    )
    model = PCA(k=k, inputCol="_c", outputCol="_p").fit(centred)
    proj = model.transform(centred).withColumn("_pa", vector_to_array("_p"))
    out = proj.select(*[c for c in df.columns if c != vector_col], *[F.col("_pa")[i].alias(f"pc_{i}") for i in range(k)])
    return out, [float(x) for x in model.explainedVariance.toArray()]


def importance_ranking(importances: DataFrame, name: str, importance: str, n: int = 20) -> DataFrame:
    """Top ``n`` features by importance; ties by name."""
    return importances.orderBy(F.desc(importance), name).limit(n)


def importance_by_category(importances: DataFrame, category: Column, importance: str) -> DataFrame:
    """Importance summed per category, descending."""
    return importances.groupBy(category.alias("category")).agg(F.sum(importance).alias("importance")).orderBy(F.desc("importance"))


