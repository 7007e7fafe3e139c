"""Prediction rows, softmax/argmax over logits and scored-set loss."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideframe.functions.sizing import MAX_BROADCAST_ROWS, check_rows

# The serving dictionary of the reference (ids 0..5, dataset order).
SERVING_CLASSES = ["WALKING", "WALKING_UPSTAIRS", "WALKING_DOWNSTAIRS", "SITTING", "STANDING", "LAYING"]


def class_name(pred: Column, names: list[str] = SERVING_CLASSES) -> Column:
    """M9: dictionary name of a class id, ``UNKNOWN_<id>`` when absent (a literal map, no join)."""
    m = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(i), F.lit(n))])
    return F.coalesce(m[pred], F.concat(F.lit("UNKNOWN_"), pred.cast("string")))


def probability_map(prob: Column, names: list[str] = SERVING_CLASSES) -> Column:
    """M9: ``class name -> probability`` from a probability vector or array."""
    arr = prob if isinstance(prob, Column) else F.col(prob)
    return F.map_from_entries(
        F.transform(arr, lambda p, i: F.struct(class_name(i, names).alias("k"), p.alias("v")))
    )


def prediction_rows(scored: DataFrame, id_col: str, pred: str, prob: str | None = None, vector: bool = False, names: list[str] = SERVING_CLASSES) -> DataFrame:
    """M9: ``id, prediction, activity`` and, when probabilities exist, ``probabilities`` map."""
    cols = [id_col, F.col(pred).cast("int").alias("prediction"), class_name(F.col(pred).cast("int"), names).alias("activity")]
    if prob is not None:
        arr = vector_to_array(F.col(prob)) if vector else F.col(prob)
        cols.append(probability_map(arr, names).alias("probabilities"))
    return scored.select(*cols)


def softmax(logits: Column) -> Column:
    """Numerically stable softmax of an array (max subtracted)."""
    mx = F.array_max(logits)
    ex = F.transform(logits, lambda v: F.exp(v - mx))
    total = F.aggregate(ex, F.lit(0.0), lambda a, v: a + v)
    return F.transform(ex, lambda v: v / total)


def argmax(values: Column) -> Column:
    """0-based index of the first maximum."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def weighted_loss_accuracy(df: DataFrame, p_true: str, weight: str, correct: str) -> DataFrame:
    """``sum(w * -ln p_true) / sum(w)`` and accuracy in one aggregate."""
    w = F.col(weight)
    return df.agg(
        (F.sum(w * -F.log(F.col(p_true))) / F.sum(w)).alias("loss"),
        F.avg(F.col(correct).cast("double")).alias("accuracy"),
    )


# ------------------------------------------------------------------ nearest class centroid
def fit_centroids(matrix_long: DataFrame, label: str = "label") -> dict[int, list[float]]:
    """Class centroids of a long matrix: ``classes x dims`` numbers (a model, bounded by its shape)."""
    cent = matrix_long.groupBy(label, "pos").agg(F.avg("val").alias("mu"))
    check_rows(cent.limit(MAX_BROADCAST_ROWS + 1).count(), what="centroid table")
    rows = cent.collect()
    out: dict[int, dict[int, float]] = {}
    for r in rows:
        out.setdefault(int(r[label]), {})[int(r["pos"])] = float(r["mu"])
    return {c: [v[i] for i in sorted(v)] for c, v in out.items()}


def centroid_distances(vec: Column, centroids: dict[int, list[float]]) -> Column:
    """Squared distances to the centroids, in the order of their labels."""
    x = F.transform(vec, lambda v: v.cast("double"))

    def distance(c: int) -> Column:
        mu = F.array(*[F.lit(m) for m in centroids[c]])
        return F.aggregate(F.zip_with(x, mu, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, t: s + t)

    return F.array(*[distance(c) for c in sorted(centroids)])


def nearest_centroid(vec: Column, centroids: dict[int, list[float]]) -> Column:
    """Label of the closest centroid (squared distance), ties to the lower label."""
    labels = F.array(*[F.lit(c) for c in sorted(centroids)])
    pairs = F.zip_with(centroid_distances(vec, centroids), labels, lambda d, c: F.struct(d.alias("d2"), c.alias("c")))
    return F.array_min(pairs)["c"]
