"""Label encoding, scaling and class weights.

Fitting returns small driver-side parameters (one value per class or per
feature, like a fitted Spark ML model); transforming is a projection with
those parameters as literals, so applying a fit never shuffles or joins.
"""

from __future__ import annotations

from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.functions.nullsafe import join_by
from strideframe.functions.sizing import local_if_small


# ----------------------------------------------------------------- D5, D6
def fit_label_encoder(df: DataFrame, label: str, output: str = "label_idx"):
    """Classes in alphabetical order -> 0..k-1; unseen labels raise at transform."""
    return StringIndexer(
        inputCol=label, outputCol=output, stringOrderType="alphabetAsc", handleInvalid="error"
    ).fit(df)


def encode_labels(df: DataFrame, label: str, output: str = "label_idx") -> DataFrame:
    model = fit_label_encoder(df, label, output)
    return model.transform(df).withColumn(output, F.col(output).cast("int"))


def decode_labels(df: DataFrame, index_col: str, labels: list[str], output: str) -> DataFrame:
    """Inverse of D5 with the fitted class list."""
    return IndexToString(inputCol=index_col, outputCol=output, labels=labels).transform(
        df.withColumn(index_col, F.col(index_col).cast("double"))
    ).withColumn(index_col, F.col(index_col).cast("int"))


def pick_label_column(df: DataFrame) -> str:
    """Label column rule: ``activity``, else ``activity_id``, else the first column."""
    for c in ("activity", "activity_id"):
        if c in df.columns:
            return c
    return df.columns[0]


# ----------------------------------------------------------------- D7, D8
def fit_scaler(df: DataFrame, cols: list[str], method: str = "standard") -> dict[str, tuple[float, float]]:
    """One aggregate over the fitting rows -> ``{col: (shift, scale)}``.

    standard: mean and POPULATION std (a zero std scales by 1);
    minmax: min and range (a zero range scales by 1).  Columns whose values are
    all NULL are left alone; no rows at all is an error.
    """
    if method == "standard":
        aggs = [F.avg(c).alias(f"a{i}") for i, c in enumerate(cols)] + [
            F.stddev_pop(c).alias(f"b{i}") for i, c in enumerate(cols)
        ]
    elif method == "minmax":
        aggs = [F.min(c).alias(f"a{i}") for i, c in enumerate(cols)] + [
            (F.max(c) - F.min(c)).alias(f"b{i}") for i, c in enumerate(cols)
        ]
    else:
        raise ValueError(f"unknown scaling method {method!r}")
    row = df.agg(F.count(F.lit(1)).alias("n"), *aggs).first()
    if not row["n"]:
        raise ValueError("no rows to fit a scaler on")
    out = {}
    for i, c in enumerate(cols):
        shift, scale = row[f"a{i}"], row[f"b{i}"]
        # a column without values stays as it is
        out[c] = (0.0, 1.0) if shift is None else (float(shift), 1.0 if scale is None or scale == 0 else float(scale))
    return out


def apply_scaler(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(s)) / F.lit(k) for c, (s, k) in params.items()})


def scale_by_split(df: DataFrame, cols: list[str], method: str = "standard", split_col: str = "split") -> DataFrame:
    """Fit on ``split = 'train'`` rows, apply to every row."""
    return apply_scaler(df, fit_scaler(df.filter(F.col(split_col) == "train"), cols, method))


# ----------------------------------------------------------------- D9, D10
def class_weights(df: DataFrame, label: str, method: str = "balanced") -> DataFrame:
    """``n / (k * count)`` per class; ``sqrt`` takes its square root."""
    if method not in ("balanced", "sqrt"):
        raise ValueError(f"unknown class weight method {method!r}")
    # the class table is evaluated once; totals and weights come from it
    counts, _ = local_if_small(df.groupBy(label).agg(F.count(F.lit(1)).alias("count")))
    totals = counts.agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("k")).first()
    w = F.lit(float(totals["n"] or 0)) / (F.lit(float(totals["k"])) * F.col("count"))
    return counts.withColumn("weight", F.sqrt(w) if method == "sqrt" else w)


def sample_weights(df: DataFrame, label: str, weights: DataFrame | dict | None = None) -> DataFrame:
    """Per-row weight from class weights (given as a table or dict, else balanced)."""
    if weights is None:
        weights = class_weights(df, label)
    if isinstance(weights, dict):
        expr = F.lit(None).cast("double")
        for k, v in weights.items():
            expr = F.when(F.col(label) == k, F.lit(float(v))).otherwise(expr)
        return df.withColumn("weight", expr)
    return join_by(df, weights.select(label, "weight"), [label], "left")


