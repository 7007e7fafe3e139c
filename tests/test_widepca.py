"""The randomised PCA against numpy."""

import numpy as np
import pytest

from strideframe.operators import correlate, gramian, widepca


def plain(x, k):
    _, s, v = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    v = v[:k] * np.sign(v[np.arange(k), np.abs(v[:k]).argmax(axis=1)])[:, None]
    return v, (s**2)[:k] / (s**2).sum()


def frame(spark, x, parts=3):
    return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "i long, v array<double>").repartition(parts)


def test_components_equal_numpy_on_64_columns(spark, monkeypatch):
    monkeypatch.setattr(gramian, "ADDED_TOGETHER", 2)
    monkeypatch.setattr(widepca, "BLOCK", 20)
    monkeypatch.setattr(widepca, "ROWS", 100)
    x = np.random.default_rng(4).normal(size=(2000, 64)) + 5
    proj, share, components = widepca.randomised_pca(frame(spark, x, 5), "v", 2)
    want, want_share = plain(x, 2)
    assert np.abs(components - want).max() < 1e-6 and np.abs(np.array(share) - want_share).max() < 1e-9
    got = {r["i"]: (r["pc_0"], r["pc_1"]) for r in proj.collect()}
    assert np.abs(np.array([got[i] for i in range(len(x))]) - (x - x.mean(axis=0)) @ want.T).max() < 1e-6


def test_many_columns(spark, monkeypatch):
    """6,000 columns, few directions: strong components are found without a square matrix; ``pca`` takes this form."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 6000)) * 0.1 + np.outer(rng.normal(size=60) * 9, rng.normal(size=6000)) + np.outer(rng.normal(size=60) * 3, rng.normal(size=6000))
    df = frame(spark, x, 2)
    _, share, components = widepca.randomised_pca(df, "v", 2, extra=8)
    want, want_share = plain(x, 2)
    assert np.abs(components - want).max() < 1e-6 and np.allclose(share, want_share, atol=1e-9)
    proj, ratios = correlate.pca(df, "v", 2)
    assert proj.columns == ["i", "pc_0", "pc_1"] and np.allclose(ratios, want_share, atol=1e-9)
    with pytest.raises(ValueError):
        widepca.randomised_pca(df, "v", 0)
