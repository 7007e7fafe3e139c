"""Model training, tuning and scoring queries (M1-M11, S8) on ``embeddings``.

A trained model's scores have no SQL twin.  The registered queries return what
SQL can check beside them: the rows of each split and fold, whether the model
beats the majority class on its training rows, the settings searched, whether each prediction is a
known class.  Tests look at the scores themselves.
"""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from strideframe.operators import learn, prep, scoring, splits
from strideframe.plans.catalog import register, with_ctes
from strideframe.plans.derived import SQL_MATRIX_LONG, SQL_SCORED, SQL_SCORED_PROB, centroids, scored, scored_prob, table
from strideframe.plans.evaluation import SQL_COMPARE, SQL_TWO_MODELS, _two_models
from strideframe.operators import evaluate as ev
from strideframe.plans.prep import TEST, VAL_OF_REST, _d, _h
from strideframe.session import checkpoint_dir

SEED = 42
#: rows of a fit that one task holds at ease, and at least while cores are idle: fits run a job for each level, whose tasks should not be tiny
ROWS_PER_TASK = 100_000
LEAST_ROWS = 5_000


def labelled(spark, d):
    """``vec_id, label (double), features, split, fold, weight``."""
    e = learn.with_features(table(spark, d, "embeddings"), "embedding").withColumn("label", F.col("label").cast("double"))
    e = splits.stratified_split(e, "vec_id", "label", 0.15, 0.15, SEED)
    e = splits.kfold(e, "vec_id", "label", 5, SEED)
    return prep.sample_weights(e, "label")


SQL_LABELLED = f"""ranked AS (
  SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY {_h("vec_id")}, vec_id) - 1 AS rk, count(*) OVER (PARTITION BY label) AS n FROM embeddings),
labelled AS (
  SELECT vec_id, label, CAST(rk % 5 AS INTEGER) AS fold,
         CASE WHEN rk < ceil(n * {_d(TEST)}) THEN 'test'
              WHEN rk < ceil(n * {_d(TEST)}) + ceil((n - ceil(n * {_d(TEST)})) * {_d(VAL_OF_REST)}) THEN 'val' ELSE 'train' END AS split
  FROM ranked)"""
SQL_SPLIT_SIZES = with_ctes(SQL_LABELLED) + "SELECT split, count(*) AS n_rows, split = 'train' AS learned FROM labelled GROUP BY split"


@contextmanager
def held(df):
    """Rows that several fits read, cached for as long as they do, in as many partitions as their size asks for."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = df.count()
        parts = max(2, -(-n // ROWS_PER_TASK), min(-(-n // LEAST_ROWS), df.sparkSession.sparkContext.defaultParallelism))
        yield df.coalesce(parts) if parts < df.rdd.getNumPartitions() else df
    finally:
        df.unpersist()


def _split_report(model, data):
    """Per split: rows, and for the training rows whether the model is right more often than the most
    frequent class (the vectors of the given tables tell little about new rows)."""
    p = model.transform(data).groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction") == F.col("label")).alias("right"))
    report = p.groupBy("split").agg(F.sum("n").alias("n_rows"), ((F.col("split") == "train") & (F.sum("right") > F.max("n"))).alias("learned"))
    rows = report.collect()  # three splits
    return data.sparkSession.createDataFrame(rows, report.schema)


def _train(data):
    return data.where(F.col("split") == "train")


@register("m1_random_forest", SQL_SPLIT_SIZES)
def m1_random_forest(spark, d):
    with held(labelled(spark, d)) as data:
        model = learn.random_forest(learn.ModelConfig(n_estimators=50), weight="weight").fit(_train(data))
        return _split_report(model, data)


@register(
    "m1_importances",
    """SELECT 'f' || i AS feature, true AS in_range, true AS sum_is_one FROM (SELECT unnest(range((SELECT max(len(embedding)) FROM embeddings))) AS i)""",
)
def m1_importances(spark, d):
    """Importances of the forest: all features named, each in [0, 1], together 1."""
    with held(labelled(spark, d)) as data:
        width = data.select(F.max(F.size("embedding"))).first()[0]
        model = learn.random_forest(learn.ModelConfig(n_estimators=20, max_depth=8)).fit(_train(data))
        table_ = learn.importances(model, [f"f{i}" for i in range(width)])
    total = table_.agg(F.sum("importance").alias("t"))
    return table_.join(F.broadcast(total)).select("feature", F.col("importance").between(0, 1).alias("in_range"), (F.abs(F.col("t") - 1) < 1e-6).alias("sum_is_one"))


@register("m2_boosted_trees", SQL_SPLIT_SIZES)
def m2_boosted_trees(spark, d):
    with held(labelled(spark, d)) as data:
        config = learn.ModelConfig(n_estimators=10, max_depth=4, max_features=None, learning_rate=0.1)
        return _split_report(learn.boosted_trees(config, weight="weight").fit(_train(data)), data)


@register("m2_probabilities", "SELECT vec_id, true AS sums_to_one, true AS most_likely FROM embeddings")
def m2_probabilities(spark, d):
    """Every row's class probabilities by the booster: together 1, the predicted class the likeliest."""
    with held(labelled(spark, d)) as data:
        config = learn.ModelConfig(n_estimators=5, max_depth=3, max_features=None)
        model = learn.boosted_trees(config, weight="weight").fit(_train(data))
    p = model.transform(labelled(spark, d)).withColumn("p", vector_to_array("probability"))
    total = F.aggregate("p", F.lit(0.0), lambda a, b: a + b)
    return p.select("vec_id", (F.abs(total - 1) < 1e-9).alias("sums_to_one"), (F.element_at("p", F.col("prediction").cast("int") + 1) == F.array_max("p")).alias("most_likely"))


@register("m3_mlp", SQL_SPLIT_SIZES)
def m3_mlp(spark, d):
    with held(labelled(spark, d)) as data:
        shape = data.agg(F.max(F.size("embedding")).alias("width"), F.max("label").alias("top")).first()
        model = learn.mlp(shape["width"], int(shape["top"]) + 1, max_iter=50).fit(_train(data))
        return _split_report(model, data)


@register(
    "m4_cross_validation",
    with_ctes(SQL_LABELLED) + "SELECT fold, count(*) AS n_rows, true AS in_range FROM labelled GROUP BY fold",
)
def m4_cross_validation(spark, d):
    with held(labelled(spark, d)) as data:
        sizes = {r[0]: r[1] for r in data.groupBy("fold").count().collect()}
        scores, mean, _ = learn.cross_validate(learn.random_forest(learn.ModelConfig(n_estimators=20, max_depth=8)), data)
    rows = [(i, sizes[i], 0 <= s <= 1 and min(scores) <= mean <= max(scores)) for i, s in enumerate(scores)]
    return spark.createDataFrame(rows, "fold int, n_rows long, in_range boolean")


GRID = {"n_estimators": [10, 20], "max_depth": [4, 8]}


def _sql_settings(maps):
    values = ", ".join(f"({i}, {m['n_estimators']}, {m['max_depth']})" for i, m in enumerate(maps))
    return f"""SELECT CAST(o AS INTEGER) AS "order", CAST(n AS INTEGER) AS n_estimators, CAST(m AS INTEGER) AS max_depth,
       (SELECT count(*) FROM embeddings) AS n_rows, true AS scored FROM (VALUES {values}) t(o, n, m)"""


def _search_frame(spark, found, n):
    ok = found.model is not None and found.best["cv_mean"] == max(r["cv_mean"] for r in found.results)
    rows = [(r["order"], r["params"]["n_estimators"], r["params"]["max_depth"], n, ok and 0 <= r["cv_mean"] <= 1) for r in found.results]
    return spark.createDataFrame(rows, "order int, n_estimators int, max_depth int, n_rows long, scored boolean")


def _searched(spark, d, maps):
    with held(labelled(spark, d)) as data:
        return _search_frame(spark, learn.search("random_forest", maps, data, weight="weight"), data.count())


@register("m5_grid_search", _sql_settings(learn.grid(GRID)))
def m5_grid_search(spark, d):
    return _searched(spark, d, learn.grid(GRID))


@register("m6_random_search", _sql_settings(learn.random_maps(GRID, 2, SEED)))
def m6_random_search(spark, d):
    return _searched(spark, d, learn.random_maps(GRID, 2, SEED))


@register(
    "m7_train_and_compare",
    with_ctes(SQL_LABELLED) + """SELECT model, "order", (SELECT count(*) FROM labelled WHERE split = 'val') AS n_val, true AS in_range, 1 AS n_best
FROM (VALUES ('random_forest', 0), ('boosted_trees', 1)) t(model, "order")""",
)
def m7_train_and_compare(spark, d):
    with held(labelled(spark, d)) as data:
        val = data.where(F.col("split") == "val")
        results, best = learn.train_and_compare(["random_forest", "boosted_trees"], _train(data), val, config=learn.ModelConfig(n_estimators=50))
        n_val = val.count()
    n_best = sum(r["order"] == best["order"] and r["score"] == max(x["score"] for x in results) for r in results)
    rows = [(r["model"], r["order"], n_val, 0 <= r["score"] <= 1, n_best) for r in results]
    return spark.createDataFrame(rows, 'model string, `order` int, n_val long, in_range boolean, n_best int')


@register(
    "m7_best_model",
    with_ctes(SQL_SCORED, SQL_TWO_MODELS, SQL_COMPARE) + "SELECT model, accuracy FROM cmp ORDER BY accuracy DESC, model_order LIMIT 1",
    floats=["accuracy"],
)
def m7_best_model(spark, d):
    two = _two_models(spark, d)
    cmp = ev.compare_models(two).join(two.select("model", "model_order").distinct(), "model")
    return cmp.orderBy(F.desc("accuracy"), "model_order").limit(1).select("model", "accuracy")


@register(
    "m8_batch_inference",
    "SELECT vec_id, true AS known_class FROM embeddings",
)
def m8_batch_inference(spark, d):
    data = labelled(spark, d)
    model = learn.fit_pipeline(learn.random_forest(learn.ModelConfig(n_estimators=20, max_depth=8)), data.where("split = 'train'"))
    classes = [int(r[0]) for r in data.select("label").distinct().collect()]
    return learn.batch_predict(model, data, ["vec_id"]).select("vec_id", F.col("prediction").isin(classes).alias("known_class"))


@register("m8_model_from_outside", with_ctes(SQL_SCORED) + "SELECT vec_id, y_pred AS prediction FROM scored")
def m8_model_from_outside(spark, d):
    """Batch inference by a numpy model (nearest class centroid) that tasks load and call with whole matrices."""
    fitted = centroids(spark, d)

    def load():
        import numpy as np

        classes = np.array(sorted(fitted), float)
        centres = np.array([fitted[c] for c in sorted(fitted)])

        def predict(x):
            # ties go to the lower class, as argmin takes the first
            return classes[((x[:, None, :] - centres) ** 2).sum(axis=2).argmin(axis=1)]

        return predict

    found = learn.predict_outside(load, table(spark, d, "embeddings").select("vec_id", "embedding"), "embedding")
    return found.select("vec_id", F.col("prediction").cast("int").alias("prediction"))


SQL_NAMES = "CASE " + " ".join(f"WHEN y_pred = {i} THEN '{n}'" for i, n in enumerate(scoring.SERVING_CLASSES)) + " ELSE 'UNKNOWN_' || y_pred END"


@register(
    "m9_prediction_rows",
    with_ctes(SQL_SCORED_PROB)
    + f"""SELECT vec_id, y_pred AS prediction, {SQL_NAMES} AS activity, max(CASE WHEN cls = y_pred THEN p END) AS p_pred
FROM scored_prob GROUP BY vec_id, y_pred""",
    floats=["p_pred"],
)
def m9_prediction_rows(spark, d):
    sp = scored_prob(spark, d)
    probs = sp.groupBy("vec_id", "y_pred").agg(F.array_sort(F.collect_list(F.struct("cls", "p"))).alias("_ps"))
    rows = scoring.prediction_rows(probs.withColumn("_arr", F.transform("_ps", lambda s: s["p"])), "vec_id", "y_pred", "_arr")
    return rows.select(
        "vec_id", "prediction", "activity", F.col("probabilities")[F.col("activity")].alias("p_pred")
    )


@register(
    "m10_softmax_argmax",
    with_ctes(SQL_MATRIX_LONG)
    + """SELECT vec_id, CAST(arg_min(pos, (-val, pos)) AS INTEGER) AS argmax, 1.0 / sum(exp(val - mx)) AS p_max
FROM (SELECT *, max(val) OVER (PARTITION BY vec_id) AS mx FROM matrix_long) GROUP BY vec_id""",
    floats=["p_max"],
)
def m10_softmax_argmax(spark, d):
    logits = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("z"))
    sm = logits.select("vec_id", scoring.argmax(F.col("z")).alias("argmax"), scoring.softmax(F.col("z")).alias("p"))
    return sm.select("vec_id", "argmax", F.array_max("p").alias("p_max"))


@register(
    "m11_weighted_loss",
    with_ctes(
        SQL_SCORED_PROB,
        """w AS (SELECT y_true, CAST(sum(c) OVER () AS DOUBLE) / (count(*) OVER () * c) AS weight
          FROM (SELECT y_true, count(*) AS c FROM scored GROUP BY y_true))""",
    )
    + """SELECT sum(w.weight * -ln(s.p)) / sum(w.weight) AS loss, avg(CASE WHEN s.y_true = s.y_pred THEN 1.0 ELSE 0.0 END) AS accuracy
FROM scored_prob s JOIN w USING (y_true) WHERE s.cls = s.y_true""",
    floats=["loss", "accuracy"],
)
def m11_weighted_loss(spark, d):
    sp = scored_prob(spark, d).where(F.col("cls") == F.col("y_true"))
    weighted = prep.sample_weights(sp, "y_true", prep.class_weights(scored(spark, d), "y_true"))
    return scoring.weighted_loss_accuracy(weighted.withColumn("correct", F.col("y_true") == F.col("y_pred")), "p", "weight", "correct")


@register("s8_model_roundtrip", "SELECT vec_id, true AS same FROM embeddings")
def s8_model_roundtrip(spark, d):
    """Fit, save to a fresh folder under the session's checkpoint folder, reload: both models predict alike."""
    data = labelled(spark, d)
    model = learn.fit_pipeline(learn.random_forest(learn.ModelConfig(n_estimators=10, max_depth=6)), data.where("split = 'train'"))
    path = os.path.join(checkpoint_dir(spark), "models", f"s8_random_forest-{uuid.uuid4().hex}")
    learn.save_model(model, path)
    again = learn.load_model(path)
    first = learn.batch_predict(model, data, ["vec_id", "features"])
    second = again.transform(first.withColumnRenamed("prediction", "first"))
    return second.select("vec_id", (F.col("first") == F.col("prediction").cast("int")).alias("same"))
