"""Classification metrics as aggregates.

Input: one row per scored sample ``(id, y_true, y_pred)`` and, for ranking
metrics, a long score table ``(id, cls, p)``.  The class list is one small
aggregate (bounded by the number of classes); everything else is grouped
counts, so metrics of billions of predictions are partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.functions.ranking import prefix_below, row_before
from strideframe.functions.sizing import local_if_small

#: labels of a dense confusion matrix
MAX_LABELS = 2000


def label_pairs(scored: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """All ``(t, p)`` pairs over the union of labels, which E1 asks for: the (counted) label table beside itself."""
    counts = scored.groupBy(y_true, y_pred).agg(F.count(F.lit(1)).alias("_c"))
    labels = counts.select(F.explode(F.array(y_true, y_pred)).alias("l")).distinct()
    labels, small = local_if_small(labels, MAX_LABELS)
    if not small:
        raise ValueError(f"more than {MAX_LABELS} labels: use the sparse counts of per_class")
    known = [r[0] for r in labels.collect()]
    every = F.array(*[F.lit(x) for x in known]).cast(T.ArrayType(scored.schema[y_true].dataType))
    return labels.select(F.col("l").alias(y_true), F.explode(every).alias(y_pred))


def confusion_matrix(scored: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """``y_true, y_pred, count`` for every label pair, zeros included."""
    counts = scored.groupBy(y_true, y_pred).agg(F.count(F.lit(1)).alias("count"))
    return label_pairs(scored, y_true, y_pred).join(counts, [y_true, y_pred], "left").fillna(0, subset=["count"])


def normalized_confusion(cm: DataFrame, y_true: str = "y_true") -> DataFrame:
    """Share of each true class (row-normalised); an empty row stays 0."""
    return cm.withColumn(
        "share", F.coalesce(F.try_divide(F.col("count"), F.sum("count").over(Window.partitionBy(y_true))), F.lit(0.0))
    )


def accuracy(scored: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """E3."""
    return scored.agg(F.avg((F.col(y_true) == F.col(y_pred)).cast("double")).alias("accuracy"))


def per_class(scored: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """``label, precision, recall, f1, support``; a zero division gives 0.

    Needs the pairs that occur only: one partial aggregate over the rows, then
    sums over its (at most classes squared) rows.
    """
    counts = scored.groupBy(F.col(y_true).alias("_t"), F.col(y_pred).alias("_p")).agg(F.count(F.lit(1)).alias("c"))
    hit = F.when(F.col("_t") == F.col("_p"), F.col("c")).otherwise(0)
    sides = F.array(
        F.struct(F.col("_t").alias("label"), F.col("c").alias("support"), F.lit(0).cast("bigint").alias("predicted"), hit.alias("tp")),
        F.struct(F.col("_p").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("c").alias("predicted"), F.lit(0).cast("bigint").alias("tp")),
    )
    m = counts.select(F.inline(sides)).groupBy("label").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    z = F.lit(0.0)
    p = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), z)
    r = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), z)
    return (
        m.withColumn("precision", p)
        .withColumn("recall", r)
        .withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), z))
        .select("label", "precision", "recall", "f1", F.col("support").cast("bigint").alias("support"))
    )


def averages(pc: DataFrame, *more) -> DataFrame:
    """E5: macro and support-weighted precision, recall and F1 (one row)."""
    n = F.sum("support")
    return pc.agg(
        *[F.avg(m).alias(f"{m}_macro") for m in ("precision", "recall", "f1")],
        *[(F.sum(F.col(m) * F.col("support")) / n).alias(f"{m}_weighted") for m in ("precision", "recall", "f1")],
        *more,
    )


def report(scored: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Class rows, then ``accuracy`` (f1 = accuracy), ``macro avg`` and ``weighted avg`` rows."""
    pc = per_class(scored, y_true, y_pred)
    rows = pc.select(F.col("label").cast("string").alias("label"), "precision", "recall", "f1", "support")
    # a true positive is recall times support; the sums give accuracy without another scan
    total = averages(pc, F.sum("support").alias("n"), F.sum(F.col("recall") * F.col("support")).alias("right"))
    none = F.lit(None).cast("double")

    def line(name, precision, recall, f1):
        return F.struct(F.lit(name).alias("label"), precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), F.col("n").cast("bigint").alias("support"))

    kinds = [line(f"{k} avg", *[F.col(f"{m}_{k}") for m in ("precision", "recall", "f1")]) for k in ("macro", "weighted")]
    return rows.unionByName(total.select(F.inline(F.array(line("accuracy", none, none, F.try_divide(F.col("right"), F.col("n"))), *kinds))))


def _score_counts(scores: DataFrame, cls: str, y_true: str, p: str) -> DataFrame:
    """Positives and negatives per ``(class, distinct score)``: map-side combined counts."""
    return scores.groupBy(cls, p).agg(
        F.count_if(F.col(y_true) == F.col(cls)).alias("pos"), F.count_if(F.col(y_true) != F.col(cls)).alias("neg")
    )


def roc_auc_by_class(scores: DataFrame, cls: str = "cls", y_true: str = "y_true", p: str = "p") -> DataFrame:
    """One-vs-rest AUC per class, exact with ties (mid-ranks).

    ``AUC = sum_s pos(s) * (neg_below(s) + neg(s) / 2) / (P * N)`` over distinct
    scores ``s``; classes with no positive or no negative give NULL.
    Only classes present in ``y_true`` are scored.
    """
    sc = prefix_below(_score_counts(scores, cls, y_true, p), [cls], p, ["neg"])
    agg = sc.groupBy(cls).agg(
        F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)).alias("_u"),
        F.sum("pos").alias("_p"),
        F.sum("neg").alias("_n"),
    )
    # doubles: the product of two counts leaves 64 bits at 4e9 rows
    pairs = F.col("_p").cast("double") * F.col("_n").cast("double")
    return agg.where(F.col("_p") > 0).select(cls, F.try_divide(F.col("_u"), pairs).alias("auc"))


def roc_auc(scores: DataFrame, cls: str = "cls", y_true: str = "y_true", p: str = "p", binary: bool = False) -> DataFrame:
    """Binary AUC (score of class 1) or the macro mean of one-vs-rest AUCs."""
    per = roc_auc_by_class(scores, cls, y_true, p)
    if binary:
        return per.where(F.col(cls) == 1).select("auc")
    return per.agg(F.avg("auc").alias("auc"))


def roc_curve(scores: DataFrame, cls: str = "cls", y_true: str = "y_true", p: str = "p", corners: bool = False) -> DataFrame:
    """Per class and distinct score (descending), cumulative TPR and FPR; plus the (0, 0) start.

    With ``corners`` a point between two equal steps goes (the curve does not
    bend there), so the curve is not as long as the number of scores.
    """
    counts = _score_counts(scores, cls, y_true, p)
    if corners:
        # the step to a point and the step after it, to the next lower score
        steps = row_before(counts, [cls], p, ["pos", "neg"])
        same = (F.col("pos") == F.col("pos_before")) & (F.col("neg") == F.col("neg_before"))
        counts = steps.withColumn("_flat", F.coalesce(same, F.lit(False))).drop("pos_before", "neg_before")
    sc = prefix_below(counts, [cls], p, ["pos", "neg"])
    tot = sc.groupBy(cls).agg(F.sum("pos").alias("_npos"), F.sum("neg").alias("_nneg"))
    joined = sc.join(tot, cls)
    if corners:
        highest = F.col("pos_below") + F.col("pos") + F.col("neg_below") + F.col("neg") == F.col("_npos") + F.col("_nneg")
        joined = joined.where(~F.col("_flat") | highest)
    pts = joined.select(
        cls,
        F.col(p).alias("threshold"),
        F.try_divide(F.col("_npos") - F.col("pos_below"), F.col("_npos")).alias("tpr"),
        F.try_divide(F.col("_nneg") - F.col("neg_below"), F.col("_nneg")).alias("fpr"),
    )
    start = tot.select(cls, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("tpr"), F.lit(0.0).alias("fpr"))
    return pts.unionByName(start)


def compare_models(scored: DataFrame, model: str = "model", y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Per model accuracy and macro / weighted metrics, one row per model."""
    counts = scored.groupBy(model, y_true, y_pred).agg(F.count(F.lit(1)).alias("c"))
    sup = counts.groupBy(model, F.col(y_true).alias("label")).agg(
        F.sum("c").alias("support"), F.sum(F.when(F.col(y_true) == F.col(y_pred), F.col("c"))).alias("tp")
    )
    prd = counts.groupBy(model, F.col(y_pred).alias("label")).agg(F.sum("c").alias("predicted"))
    m = sup.join(prd, [model, "label"], "full").fillna(0, subset=["support", "tp", "predicted"])
    z = F.lit(0.0)
    m = (
        m.withColumn("precision", F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), z))
        .withColumn("recall", F.coalesce(F.try_divide(F.col("tp"), F.col("support")), z))
        .withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), z))
    )
    return m.groupBy(model).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"),
    )


def best_per_metric(table: DataFrame, model: str, order: str, metrics: list[str]) -> DataFrame:
    """Best model per metric; ties go to the first model in ``order``."""
    long = table.unpivot([model, order], metrics, "metric", "value")
    w = Window.partitionBy("metric").orderBy(F.desc("value"), order)
    return long.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("metric", model, "value")
