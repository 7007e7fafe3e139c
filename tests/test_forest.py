"""Forests of great depth: branches grown where their rows meet."""

import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from strideframe.operators import boosting, forest, learn


def frame(spark, n=900, seed=0, parts=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 6))
    y = (x[:, 0] > 0).astype(int) + (x[:, 1] * x[:, 2] > 0.3)
    rows = [(i, float(c), [float(v) for v in r], 1.0 + i % 2) for i, (r, c) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "i long, label double, features array<double>, w double").repartition(parts, "i")


def votes(model, df):
    return {r["i"]: r["probability"].toArray() for r in model.transform(df).collect()}


def test_a_forest_of_unlimited_depth_learns_what_holds_on_other_rows(spark):
    df = frame(spark).cache()
    estimator = learn.random_forest(learn.ModelConfig(n_estimators=30), weight="w")
    # its nodes are as many as its rows: no table of sums for each
    assert isinstance(estimator, forest.Forest)
    assert not isinstance(learn.random_forest(learn.ModelConfig(max_depth=8)), forest.Forest)
    model = estimator.fit(df.where("i < 600"))
    assert learn.accuracy(model, df.where("i >= 600")) > 0.8
    assert learn.accuracy(model, df.where("i < 600")) > 0.95
    assert all(abs(p.sum() - 1) < 1e-9 for p in votes(model, df).values())
    table = learn.importances(model, [f"f{i}" for i in range(6)]).collect()
    assert {r["feature"] for r in table[:3]} == {"f0", "f1", "f2"} and abs(sum(r["importance"] for r in table) - 1) < 1e-9
    path = tempfile.mkdtemp(prefix="sf-forest-")
    learn.save_model(model, path)
    again, before = votes(learn.load_model(path, "deep_forest"), df), votes(model, df)
    assert all((again[i] == before[i]).all() for i in before)


def test_upper_levels_from_sums_equal_branches_from_rows(spark, monkeypatch):
    monkeypatch.setattr(boosting, "TASK_BYTES", 1)
    monkeypatch.setattr(forest, "ADDED_TOGETHER", 2)
    df = frame(spark, 400, parts=5).cache()
    grown = []
    for rows in (10_000, 60, 0):
        monkeypatch.setattr(forest, "NODE_ROWS", rows)
        grown.append(votes(forest.Forest(n_estimators=4, max_features=None, weight_col="w").fit(df), df))
    # equal gains are few: a draw between two splits may fall either way
    for other in grown[1:]:
        assert np.mean([np.allclose(grown[0][i], other[i]) for i in grown[0]]) > 0.95


def test_a_tree_equals_a_plain_one(spark):
    rng = np.random.default_rng(3)
    bins, label, weight = rng.integers(0, 32, (80, 3)).astype(np.uint8), rng.integers(0, 3, 80), rng.uniform(0.5, 2, 80)

    def plain(rows):
        total = np.bincount(label[rows], weight[rows], 3)
        score = lambda r: (np.bincount(label[r], weight[r], 3) ** 2).sum() / weight[r].sum()
        best = (1e-9, None)
        for f in range(3):
            for cut in range(31):
                a, b = rows[bins[rows, f] <= cut], rows[bins[rows, f] > cut]
                if min(len(a), len(b)) >= 2 and score(a) + score(b) - score(rows) > best[0] + 1e-12:
                    best = (score(a) + score(b) - score(rows), (a, b))
        if best[1] is None:
            return {i: total for i in rows.tolist()}
        return plain(best[1][0]) | plain(best[1][1])

    feature, cut, left, sums, _ = forest.grow_branch(bins, label, weight, np.ones(80, int), 3, 30, 3, 2, rng)
    want, at = plain(np.arange(80)), forest._walk(bins, feature, cut, left)
    assert all(np.allclose(sums[at[i]], want[i]) for i in range(80))


def test_deep_forest_refuses_rows_that_it_cannot_learn_from(spark):
    df = frame(spark, 20)
    for bad in (df.limit(0), df.withColumn("label", F.lit(None).cast("double")), df.withColumn("features", F.array(F.lit(None).cast("double")))):
        with pytest.raises(ValueError):
            forest.Forest(n_estimators=2).fit(bad)
