"""Blocked correlations against numpy."""

import numpy as np
import pytest

from strideframe.operators import correlate, gramian


def matrix_of(found, width):
    out = np.full((width, width), np.inf)
    for r in found.collect():
        out[r["i"], r["j"]] = r["r"]
    return out


@pytest.mark.parametrize(("features", "rows", "together"), [(512, 1024, 32), (4, 16, 2), (7, 1, 3), (1, 50, 32)])
def test_blocks_equal_numpy(spark, monkeypatch, features, rows, together):
    monkeypatch.setattr(gramian, "BATCHES", 2)
    monkeypatch.setattr(gramian, "ADDED_TOGETHER", together)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(120, 11)) + 1e6
    x[:, 3] += x[:, 5]
    x[:, 9] = 4.0
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").repartition(3)
    got = matrix_of(gramian.blocked_correlation(df, "v", features, rows), 11)
    with np.errstate(invalid="ignore", divide="ignore"):
        want = np.corrcoef(x.T)
    np.fill_diagonal(want, 1.0)
    assert np.allclose(got, want, atol=1e-9, equal_nan=True) and np.isnan(got[9, 0])


def test_wide_tables_take_the_blocked_path(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 9))
    x[:, 4] = x[:, 2] + 0.01 * x[:, 1]
    names = [f"f{i}" for i in range(9)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{n} double" for n in names))
    dense = matrix_of(correlate.correlation_matrix(df, cols=names), 9)
    monkeypatch.setattr(correlate, "DENSE", 4)
    wide = correlate.correlation_matrix(df, cols=names)
    assert np.allclose(matrix_of(wide, 9), dense, atol=1e-9)
    assert [(r["i"], r["j"]) for r in correlate.correlated_pairs(wide, 0.95).collect()] == [(2, 4)]


def test_many_features_need_no_square_matrix_in_one_place(spark):
    """3,000 features: the result is spread over its block pairs."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(30, 3000)).round(3)
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").repartition(2)
    strong = gramian.blocked_correlation(df, "v", features=1000).where("i < j and abs(r) > 0.75").collect()
    want = np.corrcoef(x.T)
    assert {(r["i"], r["j"]) for r in strong} == {(i, j) for i, j in zip(*np.where(np.triu(np.abs(want), 1) > 0.75), strict=True)}
