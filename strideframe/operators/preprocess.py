"""fit/transform preprocessing: drop correlated features, select k best, split, scale.

The fitted state is small and driver-side (kept column names, per-column
shift/scale literals, the class list), like a fitted Spark ML model; fitting
runs distributed aggregates and ``transform`` is a projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.operators import correlate, information, prep, splits, stats

#: scores to select by: nearest-neighbour or binned mutual information, ANOVA F
SELECTIONS = ("mutual_info", "binned_mutual_info", "f_classif")

#: classes that the fitted state holds at most
MAX_CLASSES = 100_000


class Preprocessor:
    def __init__(
        self,
        normalize: bool = True,
        remove_correlated: bool = False,
        correlation_threshold: float = 0.95,
        n_select_features: int | None = None,
        selection: str = "mutual_info",
    ) -> None:
        if selection not in SELECTIONS:
            raise ValueError(f"selection must be one of {', '.join(SELECTIONS)}, got {selection!r}")
        self.selection = selection
        self.normalize = normalize
        self.remove_correlated = remove_correlated
        self.correlation_threshold = correlation_threshold
        self.n_select_features = n_select_features
        self.selected_features: list[str] | None = None
        self.scaler: dict[str, tuple[float, float]] | None = None
        self.classes: list | None = None

    @property
    def is_fitted(self) -> bool:
        return self.selected_features is not None

    def fit_transform(
        self,
        df: DataFrame,
        id_col: str,
        label: str,
        features: list[str],
        val_size: float = 0.15,
        test_size: float = 0.15,
        seed: int = 42,
    ) -> DataFrame:
        cols = list(features)
        if self.remove_correlated:
            corr = correlate.correlation_matrix(df, cols=cols)
            dropped = {
                r["j"] for r in correlate.correlated_pairs(corr, self.correlation_threshold).select("j").distinct().collect()
            }
            cols = [c for i, c in enumerate(cols) if i not in dropped]
        if self.n_select_features is not None:
            long = stats.unpivot(df, [id_col, label], cols)
            if self.selection == "mutual_info":
                scores, score = information.neighbour_information(long, id_col, "feature", label, "value"), "mi"
            elif self.selection == "binned_mutual_info":
                scores, score = correlate.binned_mutual_information(long, "feature", label, "value"), "mi"
            else:
                scores, score = correlate.anova_f(long, "feature", label, "value"), "f_score"
            best = correlate.top_k(scores, score, self.n_select_features, "feature")
            chosen = {r["feature"] for r in best.collect()}
            cols = [c for c in cols if c in chosen]  # original order kept (C6)
        self.selected_features = cols
        classes = df.select(label).where(F.col(label).isNotNull()).distinct().limit(MAX_CLASSES + 1).collect()
        if len(classes) > MAX_CLASSES:
            raise ValueError(f"more than {MAX_CLASSES} classes")
        self.classes = sorted(r[0] for r in classes)
        split = splits.stratified_split(df.select(id_col, label, *cols), id_col, label, val_size, test_size, seed)
        if self.normalize:
            self.scaler = prep.fit_scaler(split.where(F.col("split") == "train"), cols, "standard")
            split = prep.apply_scaler(split, self.scaler)
        return split

    def transform(self, df: DataFrame) -> DataFrame:
        if not self.is_fitted:
            raise ValueError("transform needs a fitted Preprocessor: call fit_transform first")
        out = df.select(*[c for c in df.columns if c not in self.selected_features], *self.selected_features)
        return prep.apply_scaler(out, self.scaler) if self.scaler else out

    def encode_labels(self, df: DataFrame, label: str, output: str = "label_idx") -> DataFrame:
        """Class number of each label, in the fitted order (NULL for a label that was not seen)."""
        return df.withColumn(output, (F.array_position(self._class_array(df, label), F.col(label)) - 1).cast("int")).withColumn(
            output, F.when(F.col(output) >= 0, F.col(output))
        )

    def inverse_transform_labels(self, df: DataFrame, index: str, output: str = "label") -> DataFrame:
        """Label of each class number (NULL for a number without class)."""
        if self.classes is None:
            raise ValueError("labels need a fitted Preprocessor: call fit_transform first")
        known = F.array(*[F.lit(c) for c in self.classes])
        return df.withColumn(output, F.try_element_at(known, F.col(index).cast("int") + 1))

    def _class_array(self, df: DataFrame, label: str):
        if self.classes is None:
            raise ValueError("labels need a fitted Preprocessor: call fit_transform first")
        return F.array(*[F.lit(c) for c in self.classes]).cast(T.ArrayType(df.schema[label].dataType))
