import numpy as np
import pytest

from strideframe.operators import freqfeat


def _one_window(spark, cols: dict[str, list[float]]):
    n = len(next(iter(cols.values())))
    rows = [(1, 0, i, *[float(cols[c][i]) for c in cols]) for i in range(n)]
    schema = "sid long, window_id long, offset int, " + ", ".join(f"`{c}` double" for c in cols)
    return spark.createDataFrame(rows, schema)


def _features(spark, cols, **kw):
    w = _one_window(spark, cols)
    n = len(next(iter(cols.values())))
    return freqfeat.extract_window_features(w, "sid", list(cols), n, **kw).first().asDict()


def test_sma_of_ones(spark):
    f = _features(spark, {"X": [1] * 10, "Y": [1] * 10, "Z": [1] * 10}, frequency_domain=False)
    assert f["sma"] == pytest.approx(1.0)


def test_zero_crossing_rate_alternating(spark):
    f = _features(spark, {"X": [1, -1, 1, -1, 1]}, frequency_domain=False)
    assert f["zcr_X"] == pytest.approx(1.0)


def test_zero_counts_as_its_own_sign(spark):
    f = _features(spark, {"X": [1, 0, -1]}, frequency_domain=False)
    assert f["zcr_X"] == pytest.approx(1.0)


def test_energy_and_iqr(spark):
    assert _features(spark, {"X": [2, 2]}, frequency_domain=False)["energy_X"] == pytest.approx(4.0)
    assert _features(spark, {"X": list(range(100))}, frequency_domain=False)["iqr_X"] == pytest.approx(49.5)


def test_entropy_constant_and_uniform(spark):
    assert _features(spark, {"X": [3.0] * 20}, frequency_domain=False)["entropy_X"] == 0.0
    f = _features(spark, {"X": list(range(100))}, frequency_domain=False)
    hist, _ = np.histogram(np.arange(100), bins=10)
    p = hist / hist.sum()
    assert f["entropy_X"] == pytest.approx(-np.sum(p * np.log(p + 1e-10)))


def test_time_domain_width_three_axes(spark):
    rng = np.random.default_rng(42)
    cols = {a: rng.normal(size=128).tolist() for a in "XYZ"}
    f = _features(spark, cols, frequency_domain=False)
    assert len([k for k in f if k not in ("sid", "window_id")]) == 33


def test_dominant_frequency_of_sine(spark):
    t = np.arange(128) / 128.0
    x = np.sin(2 * np.pi * 5 * t)
    f = _features(spark, {"0": x.tolist()}, time_domain=False, rate=128.0, n_coeffs=5)
    assert abs(f["dominant_freq_0"] - 5.0) <= 1.0
    assert len([k for k in f if k not in ("sid", "window_id")]) == 4 + 5


def test_spectrum_matches_numpy_and_native(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=32)
    w = _one_window(spark, {"x": x.tolist()})
    native = {r["k"]: r["mag"] for r in freqfeat.spectrum_dft(w, "sid", "x", 32).collect()}
    fast = _features(spark, {"x": x.tolist()}, time_domain=False, n_coeffs=17)
    ref = np.abs(np.fft.rfft(x))
    for k in range(17):
        assert native[k] == pytest.approx(ref[k], abs=1e-9)
        assert fast[f"fft_coeff_{k}_x"] == pytest.approx(ref[k], abs=1e-9)
    assert fast["spectral_energy_x"] == pytest.approx(float(np.sum(ref**2)))
