"""The multi-class booster against a plain version, and on a table with signal."""

import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from strideframe.operators import boosting, evaluate, learn


def table(n=900, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 6))
    y = (x[:, 0] > 0).astype(int) + (x[:, 1] * x[:, 2] > 0.3)
    x[rng.random(x.shape) < 0.02] = np.nan
    return x, y


def frame(spark, x, y, parts=3):
    rows = [(i, float(c), [float(v) for v in r], 1.0 + i % 2) for i, (r, c) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "i long, label double, features array<double>, w double").repartition(parts, "i")


def plain_booster(bins, y, weight, classes, rounds, depth, rate, n_bins):
    """Row lists and loops; returns the margins of the training rows."""
    margins = np.zeros((len(y), classes))
    for _ in range(rounds):
        e = np.exp(margins - margins.max(axis=1, keepdims=True))
        p = e / e.sum(axis=1, keepdims=True)
        step = np.zeros_like(margins)
        for k in range(classes):
            g, h = weight * (p[:, k] - (y == k)), weight * np.maximum(2 * p[:, k] * (1 - p[:, k]), 1e-16)
            nodes = [np.arange(len(y))]
            for level in range(depth + 1):
                after = []
                for rows in nodes:
                    total = g[rows].sum() ** 2 / (h[rows].sum() + 1)
                    best = (0.0, None)
                    for f in range(bins.shape[1]) if level < depth else []:
                        for cut in range(n_bins - 1):
                            left = rows[bins[rows, f] <= cut]
                            right = rows[bins[rows, f] > cut]
                            if h[left].sum() < 1 or h[right].sum() < 1:
                                continue
                            gain = (g[left].sum() ** 2 / (h[left].sum() + 1) + g[right].sum() ** 2 / (h[right].sum() + 1) - total) / 2
                            if gain > best[0] + 1e-12:
                                best = (gain, (left, right))
                    if best[1] is None:
                        step[rows, k] = -rate * g[rows].sum() / (h[rows].sum() + 1)
                    else:
                        after += best[1]
                nodes = after
        margins += step
    return margins


@pytest.mark.parametrize("parts", [1, 5])
def test_booster_equals_a_plain_one(spark, monkeypatch, parts):
    monkeypatch.setattr(boosting, "CHECKPOINT_ROUNDS", 2)
    monkeypatch.setattr(boosting, "ADDED_TOGETHER", 2)
    if parts > 1:
        monkeypatch.setattr(boosting, "TASK_BYTES", 1)
    monkeypatch.setattr(boosting, "FEATURE_BLOCK", 4)
    x, y = table(200)
    df = frame(spark, x, y, parts)
    model = boosting.Booster(n_estimators=5, max_depth=3, learning_rate=0.3, bins=8, weight_col="w").fit(df)
    got = {r["i"]: r["rawPrediction"].toArray() for r in model.transform(df).collect()}
    bins = boosting._binned(x, model.cuts)
    want = plain_booster(bins.astype(int), y, 1.0 + np.arange(len(y)) % 2, 3, 5, 3, 0.3, 8)
    assert max(np.abs(got[i] - want[i]).max() for i in got) < 1e-6


def test_booster_learns_what_holds_on_other_rows(spark):
    x, y = table()
    df = frame(spark, x, y).cache()
    train, test = df.where("i < 600"), df.where("i >= 600")
    model = learn.boosted_trees(learn.ModelConfig(n_estimators=20, max_depth=4, max_features=None, learning_rate=0.3)).fit(train)
    assert learn.accuracy(model, test) > 0.85
    probs = model.transform(test).select("i", F.col("label").cast("int").alias("y"), "prediction", "probability").collect()
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 and r["probability"].argmax() == r["prediction"] for r in probs)
    long = spark.createDataFrame([(r["i"], r["y"], k, float(p)) for r in probs for k, p in enumerate(r["probability"])], "vec_id long, y_true int, cls int, p double")
    aucs = [r["auc"] for r in evaluate.roc_auc_by_class(long).collect()]
    assert len(aucs) == 3 and min(aucs) > 0.9
    top = [r["feature"] for r in learn.importances(model, [f"f{i}" for i in range(6)]).limit(3).collect()]
    assert set(top) == {"f0", "f1", "f2"}


def test_booster_settings_and_saving(spark):
    x, y = table(300)
    df = frame(spark, x, y)
    for extra in ({"subsample": 0.5}, {"max_features": "sqrt"}, {"max_features": 0.5, "min_child_weight": 5.0}):
        model = boosting.Booster(n_estimators=3, max_depth=2, **extra).fit(df)
        assert learn.accuracy(model, df) > 0.5
    path = tempfile.mkdtemp(prefix="sf-boost-")
    learn.save_model(model, path)
    again = learn.load_model(path, "boosted_trees")
    a, b = ([tuple(r["probability"]) for r in m.transform(df).orderBy("i").collect()] for m in (model, again))
    assert a == b
    assert learn.batch_predict(again, df, ["i"]).count() == 300
    with pytest.raises(ValueError):
        boosting.Booster().fit(df.limit(0))
    with pytest.raises(ValueError):
        boosting.Booster(max_depth=0).fit(df)


def test_small_tables_are_spread_over_idle_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(1000, numPartitions=1)
    assert [boosting.spread(rows, n << 20)[1] for n in (1, 2, 1000)] == [1, min(2, cores), cores]
    wide = spark.range(1000, numPartitions=40)
    assert [boosting.spread(wide, n << 20)[1] for n in (1, 640)] == [1, max(10, cores)]
