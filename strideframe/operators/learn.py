"""Model training, tuning and batch scoring with Spark ML.

Training data stay distributed: estimators are Spark ML's, fitting is a
sequence of distributed aggregations, and only model parameters (bounded by
features x classes or by the tree budget) live on the driver.  Folds come
from ``splits.kfold`` (md5 ranks), so cross-validation is reproducible.
"""

from __future__ import annotations

import random
from dataclasses import dataclass, replace
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, predict_batch_udf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.operators.boosting import BoostedModel, Booster
from strideframe.operators.forest import Forest, ForestModel

MAX_TREE_DEPTH = 30  # Spark's limit stands in for "unlimited" depth
#: depth up to which a forest is Spark's, which holds a table of sums for each node; deeper ones have as many nodes as rows
TABLE_DEPTH = 12


@dataclass
class ModelConfig:
    """Settings that models share; each estimator takes those it has.

    ``max_features``: ``sqrt``, ``log2``, ``None`` (all) or a fraction of the features at a split.
    """

    n_estimators: int = 100
    max_depth: int | None = None
    min_samples_split: int = 2
    min_samples_leaf: int = 1
    max_features: str | float | None = "sqrt"
    learning_rate: float = 0.1
    subsample: float = 1.0
    random_state: int = 42

    @property
    def instances_per_node(self) -> int:
        """Spark bounds the children of a split; a parent of ``min_samples_split`` rows has about half in each."""
        return max(1, self.min_samples_leaf, self.min_samples_split // 2)

    @property
    def subset_strategy(self) -> str:
        return "all" if self.max_features is None else str(self.max_features)


# Default search spaces, in terms of ModelConfig (``colsample_bytree`` is ``max_features``,
# ``min_child_weight`` is ``min_samples_leaf``).
DEFAULT_GRIDS = {
    ("random_forest", "grid"): {
        "n_estimators": [50, 100, 200],
        "max_depth": [None, 10, 20, 30],
        "min_samples_split": [2, 5, 10],
        "min_samples_leaf": [1, 2, 4],
    },
    ("random_forest", "random"): {
        "n_estimators": [50, 100, 150, 200, 300],
        "max_depth": [None, 5, 10, 15, 20, 30],
        "min_samples_split": [2, 5, 10, 15],
        "min_samples_leaf": [1, 2, 4, 8],
        "max_features": ["sqrt", "log2", None],
    },
    ("boosted_trees", "grid"): {
        "n_estimators": [50, 100, 200],
        "max_depth": [3, 5, 7],
        "learning_rate": [0.01, 0.1, 0.2],
        "subsample": [0.8, 1.0],
    },
    ("boosted_trees", "random"): {
        "n_estimators": [50, 100, 150, 200, 300],
        "max_depth": [3, 4, 5, 6, 7, 8, 10],
        "learning_rate": [0.01, 0.05, 0.1, 0.15, 0.2, 0.3],
        "subsample": [0.6, 0.7, 0.8, 0.9, 1.0],
        "max_features": [0.6, 0.7, 0.8, 0.9, 1.0],
        "min_samples_leaf": [1, 3, 5, 7],
    },
}


def default_grid(kind: str, search_type: str = "grid") -> dict:
    """M5/M6: the default search space of a model kind."""
    if (kind, search_type) not in DEFAULT_GRIDS:
        raise ValueError(f"no default search space for {kind!r} with {search_type!r}")
    return DEFAULT_GRIDS[kind, search_type]


def with_features(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    """``array<float|double>`` to an ML vector column."""
    return df.withColumn(out, array_to_vector(F.transform(F.col(array_col), lambda x: x.cast("double"))))


def random_forest(config: ModelConfig | None = None, label: str = "label", weight: str | None = None) -> RandomForestClassifier | Forest:
    """M1: class-balanced forest when a weight column (D10) is given."""
    c = config or ModelConfig()
    depth = MAX_TREE_DEPTH if c.max_depth is None else c.max_depth
    if TABLE_DEPTH < depth <= MAX_TREE_DEPTH:
        return Forest(
            n_estimators=c.n_estimators,
            max_depth=depth,
            min_instances=c.instances_per_node,
            max_features=c.max_features,
            subsample=c.subsample,
            seed=c.random_state,
            label_col=label,
            weight_col=weight,
        )
    rf = RandomForestClassifier(
        labelCol=label,
        featuresCol="features",
        numTrees=c.n_estimators,
        maxDepth=depth,
        minInstancesPerNode=c.instances_per_node,
        featureSubsetStrategy=c.subset_strategy,
        subsamplingRate=c.subsample,
        seed=c.random_state,
    )
    if weight:
        rf.setWeightCol(weight)
    return rf


def boosted_trees(config: ModelConfig | None = None, label: str = "label", weight: str | None = None) -> Booster:
    """M2: one multi-class booster with a softmax objective (depth 6, rate 0.1 by default); its model gives probabilities."""
    c = config or ModelConfig(max_depth=6, max_features=None)
    return Booster(
        n_estimators=c.n_estimators,
        max_depth=c.max_depth or 6,
        learning_rate=c.learning_rate,
        subsample=c.subsample,
        max_features=c.max_features,
        min_child_weight=c.min_samples_leaf,
        seed=c.random_state,
        label_col=label,
        weight_col=weight,
    )


def importances(model, names: list[str]) -> DataFrame:
    """M1/M2: ``feature, importance`` of a fitted model, most important first (ties by name).

    The table has one row for each feature, as the model has.
    """
    fitted = model.stages[-1] if isinstance(model, PipelineModel) else model
    if isinstance(fitted, (BoostedModel, ForestModel)):
        values = fitted.importances
    elif hasattr(fitted, "featureImportances"):
        values = [float(v) for v in fitted.featureImportances.toArray()]
    else:
        raise ValueError(f"{type(fitted).__name__} has no feature importances")
    spark = SparkSession.getActiveSession()
    rows = sorted(zip(names, values, strict=True), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows, "feature string, importance double")


def mlp(n_features: int, n_classes: int, hidden=(256, 128), max_iter: int = 100, seed: int = 42, label: str = "label"):
    """M3: feed-forward classifier ``d -> 256 -> 128 -> k``."""
    return MultilayerPerceptronClassifier(
        layers=[n_features, *hidden, n_classes], maxIter=max_iter, seed=seed, labelCol=label, featuresCol="features"
    )


def accuracy(model, df: DataFrame, label: str = "label") -> float:
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName="accuracy")
    return float(ev.evaluate(model.transform(df)))


def _parallel(spark: SparkSession, jobs: list, parallelism: int) -> list:
    """Run callables that start Spark jobs, a few at a time; results in their order."""
    if parallelism <= 1 or len(jobs) <= 1:
        return [job() for job in jobs]
    with ThreadPool(min(parallelism, len(jobs))) as pool:
        return pool.map(lambda run: run(), [inheritable_thread_target(spark)(job) for job in jobs])


def cross_validate(
    estimator, df: DataFrame, fold_col: str = "fold", label: str = "label", metric: str = "accuracy", parallelism: int = 4
):
    """M4: per-fold scores, their mean and POPULATION std (folds from a fold column); folds are fitted in parallel."""
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)
    folds = sorted(r[0] for r in df.select(fold_col).distinct().collect())

    def job(k):
        def run():
            model = estimator.fit(df.where(F.col(fold_col) != k))
            return float(ev.evaluate(model.transform(df.where(F.col(fold_col) == k))))

        return run

    scores = _parallel(df.sparkSession, [job(k) for k in folds], parallelism)
    mean = sum(scores) / len(scores)
    std = (sum((s - mean) ** 2 for s in scores) / len(scores)) ** 0.5
    return scores, mean, std


def grid(param_grid: dict) -> list[dict]:
    """M5: every combination of a ``{param: [values]}`` grid, in order."""
    maps: list[dict] = [{}]
    for p, values in param_grid.items():
        maps = [{**m, p: v} for m in maps for v in values]
    return maps


def random_maps(param_grid: dict, n_iter: int, seed: int = 42) -> list[dict]:
    """M6: ``n_iter`` param maps drawn with a fixed seed (distinct while possible)."""
    allm = grid(param_grid)
    rng = random.Random(seed)
    return rng.sample(allm, min(n_iter, len(allm)))


@dataclass
class SearchResult:
    """M5/M6: scores of all settings, the best one, and its model fitted on all rows if asked."""

    results: list[dict]
    best: dict
    model: object | None = None


def search(
    kind: str,
    maps: list[dict],
    df: DataFrame,
    base: ModelConfig | None = None,
    refit: bool = True,
    fold_col: str = "fold",
    label: str = "label",
    weight: str | None = None,
    parallelism: int = 4,
) -> SearchResult:
    """M5/M6: cross-validated score of each setting (ModelConfig fields); best = highest mean, first on ties.

    All fits of all settings and folds run ``parallelism`` at a time.
    """
    base = base or ModelConfig()

    def job(m):
        est = make_estimator(kind, replace(base, **m), label=label, weight=weight)
        return lambda: cross_validate(est, df, fold_col, label, parallelism=1)

    scores = _parallel(df.sparkSession, [job(m) for m in maps], parallelism)
    results = [{"order": i, "params": m, "cv_mean": mean, "cv_std": std} for i, (m, (_, mean, std)) in enumerate(zip(maps, scores, strict=True))]
    best = max(results, key=lambda r: (r["cv_mean"], -r["order"]))
    model = make_estimator(kind, replace(base, **best["params"]), label=label, weight=weight).fit(df) if refit else None
    return SearchResult(results, best, model)


KNOWN_MODELS = ("random_forest", "boosted_trees", "mlp")


def make_estimator(
    kind: str,
    config: ModelConfig | None = None,
    n_features: int | None = None,
    n_classes: int | None = None,
    label: str = "label",
    weight: str | None = None,
):
    """M7: estimator by name; an unknown type is an error."""
    if kind == "random_forest":
        return random_forest(config, label, weight)
    if kind == "boosted_trees":
        return boosted_trees(config, label, weight)
    if kind == "mlp":
        if n_features is None or n_classes is None:
            raise ValueError("mlp needs n_features and n_classes")
        return mlp(n_features, n_classes, label=label)
    raise ValueError(f"no estimator is named {kind!r}; there are {', '.join(KNOWN_MODELS)}")


def train_and_compare(kinds: list[str], train: DataFrame, val: DataFrame | None = None, label: str = "label", **kw):
    """M7: fit several models; the best by validation (else training) accuracy, first on ties."""
    results = []
    for order, kind in enumerate(kinds):
        model = make_estimator(kind, **kw).fit(train)
        score = accuracy(model, val if val is not None else train, label)
        results.append({"order": order, "model": kind, "score": score, "fitted": model})
    best = max(results, key=lambda r: (r["score"], -r["order"]))
    return results, best


def fit_pipeline(estimator, df: DataFrame):
    """The fitted pipeline of an estimator, or the model of a booster or deep forest, which transforms alike."""
    return estimator.fit(df) if isinstance(estimator, (Booster, Forest)) else Pipeline(stages=[estimator]).fit(df)


def save_model(model, path: str) -> None:
    """Persist a fitted pipeline, booster or deep forest (overwrite)."""
    if isinstance(model, (BoostedModel, ForestModel)):
        model.save(SparkSession.getActiveSession(), path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str, kind: str = "pipeline"):
    """A saved model; ``kind`` is ``pipeline``, ``boosted_trees`` or ``deep_forest``."""
    own = {"boosted_trees": BoostedModel, "deep_forest": ForestModel}
    if kind in own:
        return own[kind].load(SparkSession.getActiveSession(), path)
    return PipelineModel.load(path)


def batch_predict(model, df: DataFrame, keep: list[str]) -> DataFrame:
    """M8: distributed batch inference (``transform``; no UDF, no driver loop)."""
    return model.transform(df).select(*keep, F.col("prediction").cast("int").alias("prediction"))


def predict_outside(make_predict, df: DataFrame, vector_col: str, out: str = "prediction", batch_size: int = 4096) -> DataFrame:
    """M8 for a model that is not Spark's: add ``out`` (double) by ``make_predict``, run batch by batch in the tasks.

    ``make_predict()`` loads the model, once for each Python worker, and returns a
    function of a matrix (rows x features) that gives one number a row.  The
    vectors have equal lengths; a NULL vector gives NULL.
    """
    predict = predict_batch_udf(make_predict, return_type=T.DoubleType(), batch_size=batch_size, input_tensor_shapes=[[_width(df, vector_col)]])
    values = F.col(vector_col).cast("array<double>")
    known = df.where(F.col(vector_col).isNotNull()).withColumn(out, predict(values))
    return known.unionByName(df.where(F.col(vector_col).isNull()).withColumn(out, F.lit(None).cast("double")))


def _width(df: DataFrame, vector_col: str) -> int:
    return df.select(F.max(F.size(vector_col))).first()[0] or 1
