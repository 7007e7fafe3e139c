"""A/B experiment statistics (X1-X9) over request, prediction and outcome logs.

Assignment is a pure function of ``(id, seed)`` (md5 bucket), so routing is a
projection: no state, no coordination, identical on every executor and in SQL.
Statistics are aggregates of per-variant counts; closed forms run on the one
row per test that those aggregates produce.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideframe.functions.hashing import bucket
from strideframe.functions.special import chi_square_tail, student_two_sided


def chi2_critical(confidence: float) -> float:
    """Chi-square quantile with one degree of freedom: the square of a normal quantile."""
    if not 0 < confidence < 1:
        raise ValueError("confidence must lie between 0 and 1")
    return NormalDist().inv_cdf((1 + confidence) / 2) ** 2


def thresholds(weights: dict[str, float]) -> list[tuple[str, int]]:
    """Cumulative bucket thresholds (0..10000) in variant order; weights must sum to 1."""
    total = sum(weights.values())
    if abs(total - 1.0) > 1e-9:
        raise ValueError(f"weights must sum to 1, got {total}")
    out, cum = [], 0.0
    for v, w in weights.items():
        cum += w
        out.append((v, int(round(cum * 10000))))
    return out


def assign_variant(id_col: Column | str, weights: dict[str, float], seed: int = 42) -> Column:
    """First variant whose cumulative threshold is above the bucket; the last is the fallback."""
    b = bucket(id_col, seed)
    th = thresholds(weights)
    expr = F.lit(th[-1][0])
    for v, t in reversed(th[:-1]):
        expr = F.when(b < t, F.lit(v)).otherwise(expr)
    return expr


def route(requests: DataFrame, id_col: str, weights: dict[str, float], seed: int = 42, forced: Column | None = None) -> DataFrame:
    """Variant per request, a forced variant overrides the hash assignment."""
    v = assign_variant(id_col, weights, seed)
    return requests.withColumn("variant", F.coalesce(forced, v) if forced is not None else v)


def attach_outcomes(routed: DataFrame, outcomes: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(outcomes joined to their routed prediction, outcomes without an assignment)."""
    joined = routed.join(outcomes, id_col, "inner")
    dropped = outcomes.join(routed.select(id_col), id_col, "left_anti")
    return joined, dropped


def variant_metrics(joined: DataFrame, variants: list[str], y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """``variant, n, correct, accuracy`` for every configured variant (empty ones have NULL accuracy)."""
    agg = joined.groupBy("variant").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(y_true) == F.col(y_pred)).alias("correct")
    )
    names = joined.sparkSession.range(1).select(F.explode(F.array(*[F.lit(v) for v in variants])).alias("variant"))
    return (
        names.join(agg, "variant", "left")
        .fillna(0, subset=["n", "correct"])
        .withColumn("accuracy", F.try_divide(F.col("correct").cast("double"), F.col("n")))
    )


def chi_square_yates(a_ok: Column, a_bad: Column, b_ok: Column, b_bad: Column) -> Column:
    """2x2 chi-square with Yates' correction (each |O - E| reduced by min(.5, |O - E|)).

    A table with a zero expected count (an empty row or column) gives 0.  Counts
    are multiplied as doubles: their products leave 64 bits at 4e9 rows a variant.
    """
    a_ok, a_bad, b_ok, b_bad = (c.cast("double") for c in (a_ok, a_bad, b_ok, b_bad))
    n = a_ok + a_bad + b_ok + b_bad
    ra, rb, c_ok, c_bad = a_ok + a_bad, b_ok + b_bad, a_ok + b_ok, a_bad + b_bad
    cells = [(a_ok, ra, c_ok), (a_bad, ra, c_bad), (b_ok, rb, c_ok), (b_bad, rb, c_bad)]
    total = None
    for o, r, c in cells:
        e = r * c / n
        dev = F.abs(o - e)
        term = (dev - F.least(F.lit(0.5), dev)) ** 2 / e
        total = term if total is None else total + term
    degenerate = (ra == 0) | (rb == 0) | (c_ok == 0) | (c_bad == 0)
    return F.when(degenerate, F.lit(0.0)).otherwise(total)


def chi2_p_value(chi2: Column) -> Column:
    """Upper tail of chi-square with 1 degree of freedom; NaN for a missing statistic."""
    return F.coalesce(chi_square_tail(chi2), F.lit(float("nan")))


def ab_result(metrics: DataFrame, control: str | None = None, confidence: float = 0.95) -> DataFrame:
    """A row for each treatment against the control: accuracies, relative improvement,
    chi-square, p-value, decision at the given confidence, sample sizes.

    The control is the variant of that name, else the first in alphabetical order.
    """
    if control is None:
        control = metrics.agg(F.min("variant")).first()[0]
    base = metrics.where(F.col("variant") == control).select(
        F.lit(control).alias("control"), F.col("n").alias("n_control"), F.col("correct").alias("ok_control")
    )
    others = metrics.where(F.col("variant") != control).select(
        F.lit(control).alias("control"), F.col("variant").alias("treatment"), F.col("n").alias("n_treatment"), F.col("correct").alias("ok_treatment")
    )
    row = others.join(F.broadcast(base), "control")  # one row: the control
    ca = F.try_divide(F.col("ok_control").cast("double"), F.col("n_control"))
    ta = F.try_divide(F.col("ok_treatment").cast("double"), F.col("n_treatment"))
    chi2 = chi_square_yates(
        F.col("ok_control"), F.col("n_control") - F.col("ok_control"), F.col("ok_treatment"), F.col("n_treatment") - F.col("ok_treatment")
    )
    return row.withColumn("chi2", chi2).select(
        "control",
        "treatment",
        ca.alias("control_accuracy"),
        ta.alias("treatment_accuracy"),
        F.when(F.coalesce(ca, F.lit(0.0)) == 0, F.lit(0.0)).otherwise((ta - ca) / ca).alias("relative_improvement"),
        "chi2",
        chi2_p_value(F.col("chi2")).alias("p_value"),
        (F.col("chi2") > F.lit(chi2_critical(confidence))).alias("significant"),
        "n_control",
        "n_treatment",
    )


def z_values(alpha: float, power: float) -> tuple[float, float]:
    nd = NormalDist()
    return nd.inv_cdf(1 - alpha / 2), nd.inv_cdf(power)


def sample_size(baseline: Column, mde: Column, z_alpha: Column, z_beta: Column) -> Column:
    """Per-variant sample size of a two-proportion test, relative effect ``mde``."""
    p1 = baseline
    p2 = baseline * (1 + mde)
    pp = (p1 + p2) / 2
    num = z_alpha * F.sqrt(2 * pp * (1 - pp)) + z_beta * F.sqrt(p1 * (1 - p1) + p2 * (1 - p2))
    return F.ceil(num * num / ((p2 - p1) * (p2 - p1))).cast("bigint")


def welch_t(df: DataFrame, group: str, a: str, b: str, value: str) -> DataFrame:
    """Welch t statistic, degrees of freedom and two-sided p-value between two groups (from count, mean, sample variance)."""
    s = df.groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("m"), F.var_samp(value).alias("v"))
    pick = lambda g, c: F.max(F.when(F.col(group) == g, F.col(c)))
    r = s.agg(*[pick(g, c).alias(f"{c}_{k}") for g, k in ((a, "a"), (b, "b")) for c in ("n", "m", "v")])
    se2 = F.col("v_a") / F.col("n_a") + F.col("v_b") / F.col("n_b")
    df_ = se2 * se2 / (
        (F.col("v_a") / F.col("n_a")) ** 2 / (F.col("n_a") - 1) + (F.col("v_b") / F.col("n_b")) ** 2 / (F.col("n_b") - 1)
    )
    found = r.select(((F.col("m_a") - F.col("m_b")) / F.sqrt(se2)).alias("t_stat"), df_.alias("dof"))
    return found.withColumn("p_value", student_two_sided(F.col("t_stat"), F.col("dof")))


def summary(weights: dict[str, float], routed: DataFrame, metrics: DataFrame) -> DataFrame:
    """Weight, routed requests and outcome metrics per variant."""
    spark = routed.sparkSession
    w = spark.range(1).select(
        F.inline(F.array(*[F.struct(F.lit(v).alias("variant"), F.lit(float(x)).alias("weight")) for v, x in weights.items()]))
    )
    n = routed.groupBy("variant").agg(F.count(F.lit(1)).alias("n_predictions"))
    return (
        w.join(n, "variant", "left")
        .join(metrics.select("variant", F.col("n").alias("n_outcomes"), "accuracy"), "variant", "left")
        .fillna(0, subset=["n_predictions", "n_outcomes"])
    )
