"""Evaluation queries (E1-E10) on the nearest-centroid scores of ``embeddings``."""

from __future__ import annotations

from pyspark.sql import functions as F

from strideframe.functions.hashing import bucket, sql_bucket
from strideframe.operators import evaluate as ev
from strideframe.plans.catalog import register, with_ctes
from strideframe.plans.derived import SQL_SCORED, SQL_SCORED_PROB, scored, scored_prob, table

SQL_CM = """labels AS (SELECT DISTINCT l FROM (SELECT y_true AS l FROM scored UNION ALL SELECT y_pred FROM scored)),
cm AS (
  SELECT t.l AS y_true, p.l AS y_pred, coalesce(c.count, 0) AS count
  FROM labels t CROSS JOIN labels p
  LEFT JOIN (SELECT y_true, y_pred, count(*) AS count FROM scored GROUP BY ALL) c ON c.y_true = t.l AND c.y_pred = p.l)"""

SQL_PER_CLASS = """pc AS (
  SELECT label, precision, recall,
         CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1, support
  FROM (SELECT r.label, r.support,
               CASE WHEN c.predicted = 0 THEN 0.0 ELSE r.tp / c.predicted END AS precision,
               CASE WHEN r.support = 0 THEN 0.0 ELSE r.tp / r.support END AS recall
        FROM (SELECT y_true AS label, sum(count) AS support, sum(CASE WHEN y_true = y_pred THEN count ELSE 0 END) AS tp
              FROM cm GROUP BY y_true) r
        JOIN (SELECT y_pred AS label, sum(count) AS predicted FROM cm GROUP BY y_pred) c USING (label)))"""

SQL_AVG = """av AS (
  SELECT avg(precision) AS precision_macro, avg(recall) AS recall_macro, avg(f1) AS f1_macro,
         sum(precision * support) / sum(support) AS precision_weighted,
         sum(recall * support) / sum(support) AS recall_weighted,
         sum(f1 * support) / sum(support) AS f1_weighted FROM pc)"""

AVG_COLS = ["precision_macro", "recall_macro", "f1_macro", "precision_weighted", "recall_weighted", "f1_weighted"]


@register("e1_confusion_matrix", with_ctes(SQL_SCORED, SQL_CM) + "SELECT y_true, y_pred, CAST(count AS BIGINT) AS count FROM cm")
def e1_confusion_matrix(spark, d):
    return ev.confusion_matrix(scored(spark, d))


@register(
    "e2_normalized_confusion",
    with_ctes(SQL_SCORED, SQL_CM)
    + """SELECT y_true, y_pred, CAST(count AS BIGINT) AS count,
       coalesce(CAST(count AS DOUBLE) / nullif(sum(count) OVER (PARTITION BY y_true), 0), 0.0) AS share FROM cm""",
    floats=["share"],
)
def e2_normalized_confusion(spark, d):
    return ev.normalized_confusion(ev.confusion_matrix(scored(spark, d)))


@register(
    "e3_accuracy",
    with_ctes(SQL_SCORED) + "SELECT avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END) AS accuracy FROM scored",
    floats=["accuracy"],
)
def e3_accuracy(spark, d):
    return ev.accuracy(scored(spark, d))


@register(
    "e4_per_class_metrics",
    with_ctes(SQL_SCORED, SQL_CM, SQL_PER_CLASS) + "SELECT label, precision, recall, f1, CAST(support AS BIGINT) AS support FROM pc",
    floats=["precision", "recall", "f1"],
)
def e4_per_class_metrics(spark, d):
    return ev.per_class(scored(spark, d))


@register("e5_average_metrics", with_ctes(SQL_SCORED, SQL_CM, SQL_PER_CLASS, SQL_AVG) + "SELECT * FROM av", floats=AVG_COLS)
def e5_average_metrics(spark, d):
    return ev.averages(ev.per_class(scored(spark, d)))


@register(
    "e6_classification_report",
    with_ctes(SQL_SCORED, SQL_CM, SQL_PER_CLASS, SQL_AVG)
    + """SELECT CAST(label AS VARCHAR) AS label, precision, recall, f1, CAST(support AS BIGINT) AS support FROM pc
UNION ALL SELECT 'accuracy', NULL, NULL, (SELECT avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END) FROM scored),
                 (SELECT count(*) FROM scored)
UNION ALL SELECT 'macro avg', precision_macro, recall_macro, f1_macro, (SELECT count(*) FROM scored) FROM av
UNION ALL SELECT 'weighted avg', precision_weighted, recall_weighted, f1_weighted, (SELECT count(*) FROM scored) FROM av""",
    floats=["precision", "recall", "f1"],
)
def e6_classification_report(spark, d):
    return ev.report(scored(spark, d))


SQL_MIDRANK_AUC = """auc AS (
  SELECT cls, (sum(r) FILTER (WHERE is_pos) - P * (P + 1) / CAST(2 AS DOUBLE)) / (P * N) AS auc
  FROM (SELECT cls, is_pos, r, count_if(is_pos) OVER (PARTITION BY cls) AS P, count_if(NOT is_pos) OVER (PARTITION BY cls) AS N
        FROM (SELECT cls, y_true = cls AS is_pos,
                     rank() OVER (PARTITION BY cls ORDER BY p)
                       + (count(*) OVER (PARTITION BY cls, p) - 1) / CAST(2 AS DOUBLE) AS r
              FROM sp))
  WHERE cls IN (SELECT DISTINCT y_true FROM sp)
  GROUP BY cls, P, N)"""


@register(
    "e7_roc_auc_by_class",
    with_ctes(SQL_SCORED_PROB, "sp AS (SELECT cls, y_true, p FROM scored_prob)", SQL_MIDRANK_AUC) + "SELECT cls, auc FROM auc",
    floats=["auc"],
)
def e7_roc_auc_by_class(spark, d):
    return ev.roc_auc_by_class(scored_prob(spark, d))


@register(
    "e7_roc_auc",
    with_ctes(SQL_SCORED_PROB, "sp AS (SELECT cls, y_true, p FROM scored_prob)", SQL_MIDRANK_AUC) + "SELECT avg(auc) AS auc FROM auc",
    floats=["auc"],
)
def e7_roc_auc(spark, d):
    return ev.roc_auc(scored_prob(spark, d))


@register(
    "e7_roc_auc_binary",
    with_ctes(
        """sp AS (SELECT 1 AS cls, l.quality AS y_true, CAST(d.n_chars AS DOUBLE) AS p
              FROM labels l JOIN documents d USING (doc_id))""",
        SQL_MIDRANK_AUC,
    )
    + "SELECT auc FROM auc WHERE cls = 1",
    floats=["auc"],
)
def e7_roc_auc_binary(spark, d):
    s = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id").select(
        F.lit(1).alias("cls"), F.col("quality").alias("y_true"), F.col("n_chars").cast("double").alias("p")
    )
    return ev.roc_auc(s, binary=True)


@register(
    "e8_roc_curve",
    with_ctes(
        SQL_SCORED_PROB,
        """cnt AS (SELECT cls, p, count_if(y_true = cls) AS pos, count_if(y_true <> cls) AS neg FROM scored_prob GROUP BY ALL)""",
    )
    + """SELECT cls, p AS threshold,
       sum(pos) OVER w / sum(pos) OVER (PARTITION BY cls) AS tpr,
       sum(neg) OVER w / sum(neg) OVER (PARTITION BY cls) AS fpr
FROM cnt WINDOW w AS (PARTITION BY cls ORDER BY p DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
UNION ALL SELECT DISTINCT cls, NULL, 0.0, 0.0 FROM cnt""",
    floats=["threshold", "tpr", "fpr"],
)
def e8_roc_curve(spark, d):
    return ev.roc_curve(scored_prob(spark, d))


@register(
    "e8_roc_corners",
    with_ctes(
        SQL_SCORED_PROB,
        """cnt AS (SELECT cls, p, count_if(y_true = cls) AS pos, count_if(y_true <> cls) AS neg FROM scored_prob GROUP BY ALL),
st AS (SELECT cls, p, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps, row_number() OVER w AS k, count(*) OVER (PARTITION BY cls) AS n,
              sum(pos) OVER (PARTITION BY cls) AS allp, sum(neg) OVER (PARTITION BY cls) AS alln
       FROM cnt WINDOW w AS (PARTITION BY cls ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
bend AS (SELECT *, lead(tps) OVER w - 2 * tps + lag(tps) OVER w AS d2t, lead(fps) OVER w - 2 * fps + lag(fps) OVER w AS d2f
         FROM st WINDOW w AS (PARTITION BY cls ORDER BY k))""",
    )
    + """SELECT cls, p AS threshold, tps / allp AS tpr, fps / alln AS fpr FROM bend WHERE k = 1 OR k = n OR d2t <> 0 OR d2f <> 0
UNION ALL SELECT DISTINCT cls, NULL, 0.0, 0.0 FROM cnt""",
    floats=["threshold", "tpr", "fpr"],
)
def e8_roc_corners(spark, d):
    """The curve without points between equal steps (second differences of both counts are zero there)."""
    return ev.roc_curve(scored_prob(spark, d), corners=True)


def _two_models(spark, d):
    s = scored(spark, d)
    a = s.select(F.lit("centroid").alias("model"), F.lit(0).alias("model_order"), "vec_id", "y_true", "y_pred")
    b = s.select(
        F.lit("random").alias("model"), F.lit(1).alias("model_order"), "vec_id", "y_true",
        F.pmod(bucket("vec_id", "guess"), F.lit(10)).cast("int").alias("y_pred"),
    )
    return a.unionByName(b)


SQL_TWO_MODELS = f"""two AS (
  SELECT 'centroid' AS model, 0 AS model_order, vec_id, y_true, y_pred FROM scored
  UNION ALL SELECT 'random', 1, vec_id, y_true, CAST({sql_bucket("vec_id", "guess")} % 10 AS INTEGER) FROM scored)"""

SQL_COMPARE = """cmp AS (
  SELECT model, any_value(model_order) AS model_order, sum(tp) / sum(support) AS accuracy, avg(precision) AS precision_macro,
         avg(recall) AS recall_macro, avg(f1) AS f1_macro, sum(f1 * support) / sum(support) AS f1_weighted
  FROM (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1
        FROM (SELECT model, model_order, label, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp,
                     CASE WHEN coalesce(predicted, 0) = 0 THEN 0.0 ELSE coalesce(tp, 0) / predicted END AS precision,
                     CASE WHEN coalesce(support, 0) = 0 THEN 0.0 ELSE coalesce(tp, 0) / support END AS recall
              FROM (SELECT model, any_value(model_order) AS model_order, y_true AS label, count(*) AS support,
                           count_if(y_true = y_pred) AS tp FROM two GROUP BY model, y_true) s
              FULL JOIN (SELECT model, any_value(model_order) AS mo2, y_pred AS label, count(*) AS predicted
                         FROM two GROUP BY model, y_pred) p USING (model, label)))
  GROUP BY model)"""

CMP_COLS = ["accuracy", "precision_macro", "recall_macro", "f1_macro", "f1_weighted"]


@register("e9_model_comparison", with_ctes(SQL_SCORED, SQL_TWO_MODELS, SQL_COMPARE) + f"SELECT model, {', '.join(CMP_COLS)} FROM cmp", floats=CMP_COLS)
def e9_model_comparison(spark, d):
    return ev.compare_models(_two_models(spark, d))


@register(
    "e10_best_per_metric",
    with_ctes(SQL_SCORED, SQL_TWO_MODELS, SQL_COMPARE)
    + f"""SELECT metric, model, value FROM (
  SELECT metric, model, value, row_number() OVER (PARTITION BY metric ORDER BY value DESC, model_order) AS rn
  FROM (UNPIVOT (SELECT model, model_order, {', '.join(CMP_COLS)} FROM cmp) ON {', '.join(CMP_COLS)} INTO NAME metric VALUE value))
WHERE rn = 1""",
    floats=["value"],
)
def e10_best_per_metric(spark, d):
    two = _two_models(spark, d)
    cmp = ev.compare_models(two).join(two.select("model", "model_order").distinct(), "model")
    return ev.best_per_metric(cmp, "model", "model_order", CMP_COLS)
