"""A/B experiment queries (X1-X9) on a request log derived from ``orders``.

Every order is a request (``sample_id = o_orderkey``); urgent orders are forced
to the treatment; ``y_true = (o_orderstatus = 'F')``; the control model is right
when ``bucket(id, 7) < 9000``, the treatment's when ``bucket(id, 8) < 9200``.
All requests and outcomes count, except in X3, whose feature is rows that do not
meet: there low-priority orders (``5-LOW``) bypass the experiment, so their
outcomes have no assignment, and pending orders (``o_orderstatus = 'P'``) have no
outcome yet.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strideframe.functions.hashing import bucket, sql_bucket
from strideframe.operators import experiments as ex
from strideframe.plans.catalog import register, with_ctes
from strideframe.plans.derived import table

WEIGHTS = {"control": 0.5, "treatment": 0.5}
VARIANTS = list(WEIGHTS)
SEED = 42
ACC = {"control": (7, 9000), "treatment": (8, 9200)}
MDES = [0.05, 0.10, 0.20]
POWERS = [0.80, 0.90]
ALPHA = 0.05
UNROUTED = "5-LOW"


def _requests(spark, d, only=None):
    o = table(spark, d, "orders")
    return (o if only is None else o.where(only)).select(F.col("o_orderkey").alias("sample_id"), "o_orderpriority", "o_totalprice")


def _predictions(spark, d):
    """Offline predictions of both variants for every order: ``sample_id, variant, y_pred``."""
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("sample_id"), (F.col("o_orderstatus") == "F").cast("int").alias("y_true")
    )
    per = F.array(
        *[
            F.struct(
                F.lit(v).alias("variant"),
                F.when(bucket("sample_id", s) < t, F.col("y_true")).otherwise(1 - F.col("y_true")).alias("y_pred"),
            )
            for v, (s, t) in ACC.items()
        ]
    )
    return o.select("sample_id", F.inline(per))


def _outcomes(spark, d, only=None):
    o = table(spark, d, "orders")
    return (o if only is None else o.where(only)).select(F.col("o_orderkey").alias("sample_id"), (F.col("o_orderstatus") == "F").cast("int").alias("y_true"))


def routed(spark, d, only=None):
    forced = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("treatment"))
    r = ex.route(_requests(spark, d, only), "sample_id", WEIGHTS, SEED, forced)
    return r.join(_predictions(spark, d), ["sample_id", "variant"], "inner")


def joined(spark, d):
    return ex.attach_outcomes(routed(spark, d), _outcomes(spark, d), "sample_id")


def partly_joined(spark, d):
    """Requests and outcomes that do not all meet."""
    bypass, pending = F.col("o_orderpriority") != UNROUTED, F.col("o_orderstatus") != "P"
    return ex.attach_outcomes(routed(spark, d, bypass), _outcomes(spark, d, pending), "sample_id")


def metrics(spark, d):
    return ex.variant_metrics(joined(spark, d)[0], VARIANTS)


_B42 = sql_bucket("o_orderkey", SEED)
SQL_AB = f"""req AS (SELECT o_orderkey AS sample_id, o_orderpriority, o_totalprice,
                    CASE WHEN {_B42} < 5000 THEN 'control' ELSE 'treatment' END AS assigned
             FROM orders),
preds AS (SELECT o_orderkey AS sample_id, 'control' AS variant,
                 CASE WHEN {sql_bucket("o_orderkey", 7)} < 9000 THEN y ELSE 1 - y END AS y_pred
          FROM (SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS y FROM orders)
          UNION ALL
          SELECT o_orderkey, 'treatment', CASE WHEN {sql_bucket("o_orderkey", 8)} < 9200 THEN y ELSE 1 - y END
          FROM (SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS y FROM orders)),
routed AS (SELECT r.sample_id, r.o_orderpriority, r.o_totalprice, r.variant, p.y_pred
           FROM (SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN 'treatment' ELSE assigned END AS variant FROM req) r
           JOIN preds p USING (sample_id, variant)),
outcomes AS (SELECT o_orderkey AS sample_id, CAST(o_orderstatus = 'F' AS INTEGER) AS y_true FROM orders),
joined AS (SELECT r.*, o.y_true FROM routed r JOIN outcomes o USING (sample_id)),
vm AS (SELECT v.variant, coalesce(m.n, 0) AS n, coalesce(m.correct, 0) AS correct,
              CAST(m.correct AS DOUBLE) / nullif(m.n, 0) AS accuracy
       FROM (VALUES ('control'), ('treatment')) v(variant)
       LEFT JOIN (SELECT variant, count(*) AS n, count_if(y_true = y_pred) AS correct FROM joined GROUP BY variant) m USING (variant))"""


def _sql_chi2(a_ok, a_bad, b_ok, b_bad):
    n = f"({a_ok} + {a_bad} + {b_ok} + {b_bad})"
    ra, rb, cok, cbad = f"({a_ok} + {a_bad})", f"({b_ok} + {b_bad})", f"({a_ok} + {b_ok})", f"({a_bad} + {b_bad})"
    terms = []
    for o, r, c in ((a_ok, ra, cok), (a_bad, ra, cbad), (b_ok, rb, cok), (b_bad, rb, cbad)):
        e = f"({r} * {c} / {n})"
        dev = f"abs({o} - {e})"
        terms.append(f"pow({dev} - least(0.5, {dev}), 2) / {e}")
    return f"CASE WHEN {ra} = 0 OR {rb} = 0 OR {cok} = 0 OR {cbad} = 0 THEN 0.0 ELSE {' + '.join(terms)} END"


SQL_ROW = """rowc AS (SELECT max(CASE WHEN variant = 'control' THEN n END) AS n_control,
                 max(CASE WHEN variant = 'control' THEN correct END) AS ok_control,
                 max(CASE WHEN variant = 'treatment' THEN n END) AS n_treatment,
                 max(CASE WHEN variant = 'treatment' THEN correct END) AS ok_treatment FROM vm)"""
_CHI = _sql_chi2(
    "CAST(ok_control AS DOUBLE)", "CAST(n_control - ok_control AS DOUBLE)",
    "CAST(ok_treatment AS DOUBLE)", "CAST(n_treatment - ok_treatment AS DOUBLE)",
)


@register(
    "x1_traffic_split",
    f"SELECT o_orderkey AS sample_id, CASE WHEN {_B42} < 5000 THEN 'control' ELSE 'treatment' END AS variant FROM orders",
)
def x1_traffic_split(spark, d):
    return _requests(spark, d).select("sample_id", ex.assign_variant("sample_id", WEIGHTS, SEED).alias("variant"))


@register("x2_route_predictions", with_ctes(SQL_AB) + "SELECT sample_id, variant, y_pred FROM routed")
def x2_route_predictions(spark, d):
    return routed(spark, d).select("sample_id", "variant", "y_pred")


SQL_AB_PARTLY = SQL_AB.replace("FROM orders),\npreds", "FROM orders WHERE o_orderpriority <> '5-LOW'),\npreds").replace(
    "AS y_true FROM orders)", "AS y_true FROM orders WHERE o_orderstatus <> 'P')"
)
assert SQL_AB_PARTLY.count("WHERE") == 2


@register("x3_attach_outcomes", with_ctes(SQL_AB_PARTLY) + "SELECT sample_id, variant, y_pred, y_true FROM joined")
def x3_attach_outcomes(spark, d):
    return partly_joined(spark, d)[0].select("sample_id", "variant", "y_pred", "y_true")


@register(
    "x3_dropped_outcomes",
    with_ctes(SQL_AB_PARTLY) + "SELECT count(*) AS n_dropped FROM outcomes WHERE sample_id NOT IN (SELECT sample_id FROM routed)",
)
def x3_dropped_outcomes(spark, d):
    return partly_joined(spark, d)[1].agg(F.count(F.lit(1)).alias("n_dropped"))


@register("x4_variant_metrics", with_ctes(SQL_AB) + "SELECT variant, n, correct, accuracy FROM vm", floats=["accuracy"])
def x4_variant_metrics(spark, d):
    return metrics(spark, d).select("variant", "n", "correct", "accuracy")


@register(
    "x5_chi_square",
    with_ctes(SQL_AB, SQL_ROW) + f"SELECT chi2, chi2 > {ex.chi2_critical(0.95)!r} AS significant FROM (SELECT {_CHI} AS chi2 FROM rowc)",
    floats=["chi2"],
)
def x5_chi_square(spark, d):
    return ex.ab_result(metrics(spark, d), "control").select("chi2", "significant")


# The p-value with one degree of freedom is erfc(sqrt(x / 2)).  SQL has no erfc, so the oracle integrates
# the normal density by Simpson's rule in 2000 steps (error below 1e-10).
_SQL_P = """(SELECT 1.0 - 2.0 * sum(w * exp(-z * z / 2)) * h / 3 / sqrt(2 * pi()) FROM (
    SELECT CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w, sqrt(chi2) / 2000 AS h, i * sqrt(chi2) / 2000 AS z
    FROM (SELECT unnest(range(2001)) AS i)) GROUP BY h)"""


@register(
    "x5_chi_square_p_value",
    with_ctes(SQL_AB, SQL_ROW) + f"SELECT chi2, {_SQL_P} AS p_value FROM (SELECT {_CHI} AS chi2 FROM rowc) q",
    floats=["chi2", "p_value"],
)
def x5_chi_square_p_value(spark, d):
    return ex.ab_result(metrics(spark, d), "control").select("chi2", "p_value")


@register(
    "x6_ab_result",
    with_ctes(SQL_AB, SQL_ROW)
    + f"""SELECT 'control' AS control, 'treatment' AS treatment, ca AS control_accuracy, ta AS treatment_accuracy,
       CASE WHEN coalesce(ca, 0) = 0 THEN 0.0 ELSE (ta - ca) / ca END AS relative_improvement,
       chi2, {_SQL_P} AS p_value, chi2 > {ex.chi2_critical(0.95)!r} AS significant, n_control, n_treatment
FROM (SELECT *, CAST(ok_control AS DOUBLE) / nullif(n_control, 0) AS ca,
             CAST(ok_treatment AS DOUBLE) / nullif(n_treatment, 0) AS ta, {_CHI} AS chi2 FROM rowc) q""",
    floats=["control_accuracy", "treatment_accuracy", "relative_improvement", "chi2", "p_value"],
)
def x6_ab_result(spark, d):
    return ex.ab_result(metrics(spark, d), "control")


def _z_table():
    return [(m, p, *ex.z_values(ALPHA, p)) for m in MDES for p in POWERS]


def _sql_sample_size():
    vals = ", ".join(f"({m!r}, {p!r}, {za!r}, {zb!r})" for m, p, za, zb in _z_table())
    return f"""SELECT o_orderpriority, mde, power,
       CAST(ceil(pow(za * sqrt(2 * pp * (1 - pp)) + zb * sqrt(p1 * (1 - p1) + p2 * (1 - p2)), 2) / ((p2 - p1) * (p2 - p1))) AS BIGINT) AS n_required
FROM (SELECT o_orderpriority, mde, power, za, zb, p1, p1 * (1 + mde) AS p2, (p1 + p1 * (1 + mde)) / 2 AS pp
      FROM (SELECT o_orderpriority, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END)::DOUBLE AS p1 FROM orders GROUP BY 1)
      CROSS JOIN (SELECT mde::DOUBLE AS mde, power::DOUBLE AS power, za::DOUBLE AS za, zb::DOUBLE AS zb
                  FROM (VALUES {vals}) t(mde, power, za, zb)))"""


@register("x7_sample_size", _sql_sample_size(), floats=["mde", "power"])
def x7_sample_size(spark, d):
    base = table(spark, d, "orders").groupBy("o_orderpriority").agg(
        F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("p1")
    )
    grid = F.array(
        *[F.struct(F.lit(m).alias("mde"), F.lit(p).alias("power"), F.lit(za).alias("za"), F.lit(zb).alias("zb")) for m, p, za, zb in _z_table()]
    )
    e = base.select("o_orderpriority", "p1", F.inline(grid))
    return e.select(
        "o_orderpriority", "mde", "power", ex.sample_size(F.col("p1"), F.col("mde"), F.col("za"), F.col("zb")).alias("n_required")
    )


@register(
    "x8_welch_t",
    with_ctes(
        SQL_AB,
        """s AS (SELECT max(CASE WHEN variant = 'control' THEN n END) AS n_a, max(CASE WHEN variant = 'control' THEN m END) AS m_a,
                 max(CASE WHEN variant = 'control' THEN v END) AS v_a, max(CASE WHEN variant = 'treatment' THEN n END) AS n_b,
                 max(CASE WHEN variant = 'treatment' THEN m END) AS m_b, max(CASE WHEN variant = 'treatment' THEN v END) AS v_b
          FROM (SELECT variant, count(o_totalprice) AS n, avg(o_totalprice) AS m, var_samp(o_totalprice) AS v FROM routed GROUP BY variant))""",
        """tt AS (SELECT (m_a - m_b) / sqrt(v_a / n_a + v_b / n_b) AS t_stat,
       pow(v_a / n_a + v_b / n_b, 2) / (pow(v_a / n_a, 2) / (n_a - 1) + pow(v_b / n_b, 2) / (n_b - 1)) AS dof FROM s)""",
        # Simpson's rule over the density up to |t|
        """area AS (SELECT sum((CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
                            * pow(1 + pow(abs(t_stat) * i / 4000, 2) / dof, -(dof + 1) / 2)) * abs(any_value(t_stat)) / 12000 AS a
                 FROM tt, (SELECT unnest(range(4001)) AS i))""",
    )
    + """SELECT t_stat, dof, 1 - 2 * a * exp(lgamma((dof + 1) / 2) - lgamma(dof / 2)) / sqrt(dof * pi()) AS p_value FROM tt, area""",
    floats=["t_stat", "dof", "p_value"],
)
def x8_welch_t(spark, d):
    return ex.welch_t(routed(spark, d), "variant", "control", "treatment", "o_totalprice")


@register(
    "x9_summary",
    with_ctes(SQL_AB)
    + """SELECT w.variant, w.weight, coalesce(r.n_predictions, 0) AS n_predictions, vm.n AS n_outcomes, vm.accuracy
FROM (SELECT * FROM (VALUES ('control', 0.5::DOUBLE), ('treatment', 0.5::DOUBLE)) t(variant, weight)) w
LEFT JOIN (SELECT variant, count(*) AS n_predictions FROM routed GROUP BY variant) r USING (variant)
LEFT JOIN vm USING (variant)""",
    floats=["weight", "accuracy"],
)
def x9_summary(spark, d):
    r = routed(spark, d)
    return ex.summary(WEIGHTS, r, metrics(spark, d))
