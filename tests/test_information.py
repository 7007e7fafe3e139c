"""Univariate scores: ANOVA F far from zero, nearest-neighbour mutual information against a plain version."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strideframe.functions import cuts
from strideframe.operators import correlate, information


def psi(n):
    return -0.5772156649015329 + sum(1.0 / i for i in range(1, n))


def plain_information(x, y, k=3):
    """All distances of all rows."""
    sizes = {c: y.count(c) for c in set(y)}
    rows = [i for i in range(len(x)) if sizes[y[i]] > 1]
    ks, ns, ms = [], [], []
    for i in rows:
        used = min(k, sizes[y[i]] - 1)
        r = sorted(abs(x[j] - x[i]) for j in rows if j != i and y[j] == y[i])[used - 1]
        m = sum(abs(x[j] - x[i]) < r for j in rows) if r > 0 else sum(x[j] == x[i] for j in rows)
        ks.append(psi(used)), ns.append(psi(sizes[y[i]])), ms.append(psi(m))
    return max(0.0, psi(len(rows)) + np.mean(ks) - np.mean(ns) - np.mean(ms))


def test_digamma(spark):
    rows = spark.range(1, 400).select("id", information.digamma(F.col("id")).alias("p")).collect()
    assert max(abs(r["p"] - psi(r["id"])) for r in rows) < 1e-12
    big = spark.range(1).select(information.digamma(F.lit(10**9)).alias("p")).first()[0]
    assert abs(big - (math.log(10**9) - 5e-10)) < 1e-12


def table(n=500, seed=4):
    """One informative feature, one with ties only, one of noise; a class of one row and one of two."""
    rng = random.Random(seed)
    labels = [rng.choice("aaabbc") for _ in range(n - 3)] + ["lone", "pair", "pair"]
    shift = {"a": 0.0, "b": 2.0, "c": 4.0, "lone": 1.0, "pair": -3.0}
    return [(i, f, y, v) for i, y in enumerate(labels) for f, v in (("signal", shift[y] + rng.gauss(0, 1)), ("ties", float(rng.randrange(6))), ("noise", rng.gauss(5, 1)))]


@pytest.mark.parametrize(("block", "per_range"), [(65_536, None), (8, 40), (6, 7)])
def test_neighbour_information_equals_all_pairs(spark, monkeypatch, block, per_range):
    if per_range:
        monkeypatch.setattr(cuts, "ROWS_PER_RANGE", per_range)
    rows = table()
    df = spark.createDataFrame(rows, "id long, f string, y string, v double").repartition(7)
    got = {r["f"]: r["mi"] for r in information.neighbour_information(df, "id", "f", "y", "v", block=block).collect()}
    fine = {(r["id"], r["f"]): r["_x"] for r in information.jitter(df, "id", "f", "v", "_x").collect()}
    for f in ("signal", "ties", "noise"):
        x, y = zip(*[(fine[i, f], y) for i, g, y, _ in rows if g == f], strict=True)
        assert abs(got[f] - plain_information(list(x), list(y))) < 1e-9
    assert got["signal"] > 0.5 > 0.1 > got["noise"]


def test_neighbour_information_of_odd_rows(spark):
    rows = [(i, "f", None if i % 2 else "a", float(i % 2) * 10 + i / 100) for i in range(40)]
    rows += [(100, "f", "a", None), (101, "f", "a", float("nan")), (102, "one", "a", 1.0), (103, "one", "b", 2.0)]
    rows += [(200 + i, "same", "ab"[i % 2], 3.0) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, f string, y string, v double")
    got = {r["f"]: r["mi"] for r in information.neighbour_information(df, "id", "f", "y", "v").collect()}
    # two classes told apart by the feature share ln 2 of information; classes of one row leave no feature
    assert abs(got["f"] - math.log(2)) < 0.1 and "one" not in got and got["same"] < 0.5
    assert information.neighbour_information(df.limit(0), "id", "f", "y", "v").count() == 0


def plain_f(groups):
    values = np.concatenate(groups)
    between = sum(len(g) * (g.mean() - values.mean()) ** 2 for g in groups) / (len(groups) - 1)
    return between / (sum(((g - g.mean()) ** 2).sum() for g in groups) / (len(values) - len(groups)))


@pytest.mark.parametrize("offset", [0.0, 1e6, 1e8, 1e9, -1e9])
def test_anova_far_from_zero(spark, offset):
    rng = np.random.default_rng(3)
    base = [rng.normal(0.1 * c, 1, 1000) for c in range(3)]
    groups = [g + offset for g in base]
    rows = [("f", str(c), float(v)) for c, g in enumerate(groups) for v in g]
    got = correlate.anova_f(spark.createDataFrame(rows, "f string, y string, v double").repartition(5), "f", "y", "v").first()["f_score"]
    want = plain_f([g - offset for g in groups])
    assert abs(got - want) < 1e-6 * want
