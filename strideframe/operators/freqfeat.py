"""Frequency-domain window features (F1-F7) and the full window extractor.

Spectrum (F1), two forms:

* ``spectrum_fft``: a scalar pandas UDF over the offset-sorted window array;
  Arrow hands it a batch of windows, numpy stacks equal-length windows into a
  matrix and runs one ``rfft`` per batch (O(n log n) per window).  This is the
  default: no row amplification, one pass.
* ``spectrum_dft``: pure DataFrame form.  A twiddle table ``(offset, k, cos,
  sin)`` of ``size * (size//2 + 1)`` rows (bounded by the window size, not the
  data) is broadcast and joined on ``offset``; real and imaginary parts are sums
  by ``(series, window, k)``.  It multiplies rows by ``size//2 + 1``, so it is
  the cross-check, not the hot path.

F2-F6 are array expressions over the magnitudes, evaluated in the JVM.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.functions.sizing import check_rows
from strideframe.operators import timefeat

EPS = 1e-10


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def rfft_magnitude(values: pd.Series) -> pd.Series:
    """|rfft(x)| of every window in the batch (windows of equal length are stacked)."""
    lengths = values.map(len, na_action="ignore")
    if len(values) and lengths.notna().all() and lengths.nunique() == 1 and lengths.iloc[0]:
        # the usual batch: windows of one length, stacked at once
        return pd.Series(list(np.abs(np.fft.rfft(np.stack(values.to_numpy()).astype(np.float64), axis=1))))
    out = [None] * len(values)
    by_len: dict[int, list[int]] = {}
    for i, v in enumerate(values):
        if v is not None:
            by_len.setdefault(len(v), []).append(i)
    for length, idx in by_len.items():
        if length == 0:
            for i in idx:
                out[i] = []
            continue
        mat = np.vstack([np.asarray(values.iloc[i], dtype=np.float64) for i in idx])
        mags = np.abs(np.fft.rfft(mat, axis=1))
        for row, i in enumerate(idx):
            out[i] = mags[row]
    return pd.Series(out)


def twiddles(spark, size: int) -> DataFrame:
    """``(offset, _k, _c, _s)``: bin ``k``, ``cos`` and ``sin`` of ``2 pi k offset / size``."""
    n_bins = size // 2 + 1
    rows = [
        (o, k, math.cos(2 * math.pi * k * o / size), math.sin(2 * math.pi * k * o / size))
        for o in range(size)
        for k in range(n_bins)
    ]
    return spark.createDataFrame(rows, "offset int, _k int, _c double, _s double")


def spectrum_dft(windowed: DataFrame, key: str, axis: str, size: int) -> DataFrame:
    """F1 native: ``(key, window_id, k, mag)`` by a broadcast twiddle join and sums."""
    check_rows(size * (size // 2 + 1), what="twiddle table")
    tw = F.broadcast(twiddles(windowed.sparkSession, size))
    x = F.col(axis).cast("double")
    return (
        windowed.select(key, "window_id", "offset", x.alias("_x"))
        .join(tw, "offset")
        .groupBy(key, "window_id", "_k")
        .agg(F.sqrt(F.sum(F.col("_x") * F.col("_c")) ** 2 + F.sum(F.col("_x") * F.col("_s")) ** 2).alias("mag"))
        .withColumnRenamed("_k", "k")
    )


def dominant_frequency(mag: Column, size: int, rate: float) -> Column:
    """frequency of the largest magnitude over k >= 1; first maximum wins."""
    tail = F.slice(mag, 2, F.greatest(F.size(mag) - 1, F.lit(1)))
    k = F.array_position(tail, F.array_max(tail))
    return k.cast("double") * F.lit(rate / size)


def spectral_energy(mag: Column) -> Column:
    """sum of squared one-sided magnitudes."""
    return F.aggregate(mag, F.lit(0.0), lambda acc, m: acc + m * m)


def spectral_entropy(mag: Column) -> Column:
    """entropy of the normalised power spectrum (1e-10 in the sum and in the log)."""
    total = spectral_energy(mag)
    return -F.aggregate(
        mag,
        F.lit(0.0),
        lambda acc, m: acc + (m * m / (total + EPS)) * F.log(m * m / (total + EPS) + EPS),
    )


def spectral_centroid(mag: Column, size: int, rate: float) -> Column:
    """``sum(f * mag) / (sum(mag) + 1e-10)`` with ``f = k * rate / size``."""
    num = F.aggregate(
        F.zip_with(mag, F.sequence(F.lit(0), F.size(mag) - 1), lambda m, k: m * k * F.lit(rate / size)),
        F.lit(0.0),
        lambda acc, v: acc + v,
    )
    den = F.aggregate(mag, F.lit(0.0), lambda acc, m: acc + m)
    return num / (den + F.lit(EPS))


def frequency_columns(mag: Column, axis: str, size: int, rate: float, n_coeffs: int) -> list[Column]:
    """F2-F6 column set of one axis, names as the reference's feature keys."""
    cols = [
        dominant_frequency(mag, size, rate).alias(f"dominant_freq_{axis}"),
        spectral_energy(mag).alias(f"spectral_energy_{axis}"),
    ]
    n_bins = size // 2 + 1
    cols += [mag[j].alias(f"fft_coeff_{j}_{axis}") for j in range(min(n_coeffs, n_bins))]
    cols += [
        spectral_entropy(mag).alias(f"spectral_entropy_{axis}"),
        spectral_centroid(mag, size, rate).alias(f"spectral_centroid_{axis}"),
    ]
    return cols


def extract_window_features(
    windowed: DataFrame,
    key: str,
    axes: list[str],
    size: int,
    rate: float = 50.0,
    n_coeffs: int = 10,
    time_domain: bool = True,
    frequency_domain: bool = True,
    label: str | None = None,
    centre_zcr: bool = False,
) -> DataFrame:
    """every enabled feature of every window from one aggregation.

    Output: ``key, window_id``, then ``mean_/std_/min_/max_/range_/median_/zcr_/
    energy_/iqr_/entropy_<axis>``, ``sma``, ``magnitude_mean``,
    ``magnitude_std``, then per axis ``dominant_freq_``, ``spectral_energy_``,
    ``fft_coeff_<j>_``, ``spectral_entropy_``, ``spectral_centroid_``, and
    ``label`` (majority, ties to the smallest) when a label column is given.
    """
    aggs: list[Column] = [timefeat.collect_sorted(axes).alias("_w")]
    if time_domain:
        for a in axes:
            aggs += timefeat.axis_aggregates(a)
        aggs += timefeat.cross_axis_aggregates(axes)
    if label is not None:
        aggs.append(F.mode(label, True).alias("label"))
    grouped = windowed.groupBy(key, "window_id").agg(*aggs)
    # Stage the per-axis arrays and their scalars as columns, so the folds below
    # reference materialised values instead of re-evaluating array expressions.
    for a in axes:
        grouped = grouped.withColumn(f"_v_{a}", timefeat.ordered_values(F.col("_w"), a))
    if time_domain:
        grouped = grouped.withColumns(
            {c: e for a in axes for c, e in (
                (f"_mn_{a}", F.array_min(f"_v_{a}")),
                (f"_mx_{a}", F.array_max(f"_v_{a}")),
                (f"_n_{a}", F.size(f"_v_{a}")),
                (f"_s_{a}", F.array_sort(f"_v_{a}")),
            )}
        )
    out: list[Column] = [F.col(key), F.col("window_id")]
    if time_domain:
        for a in axes:
            v = F.col(f"_v_{a}")
            srt, n = F.col(f"_s_{a}"), F.col(f"_n_{a}")
            out += [F.col(f"{s}_{a}") for s in ("mean", "std", "min", "max", "range")]
            out.append(timefeat.sorted_quantile(srt, n, 0.5).alias(f"median_{a}"))
            centre = F.col(f"mean_{a}") if centre_zcr else None
            out.append(timefeat.zero_crossing_rate(v, centre).alias(f"zcr_{a}"))
            out.append(F.col(f"energy_{a}"))
            out.append((timefeat.sorted_quantile(srt, n, 0.75) - timefeat.sorted_quantile(srt, n, 0.25)).alias(f"iqr_{a}"))
            out.append(timefeat.entropy_of_sorted(srt, F.col(f"_mn_{a}"), F.col(f"_mx_{a}"), n).alias(f"entropy_{a}"))
        out += [F.col("sma"), F.col("magnitude_mean"), F.col("magnitude_std")]
    if frequency_domain:
        for a in axes:
            grouped = grouped.withColumn(f"_m_{a}", rfft_magnitude(F.col(f"_v_{a}")))
        for a in axes:
            out += frequency_columns(F.col(f"_m_{a}"), a, size, rate, n_coeffs)
    if label is not None:
        out.append(F.col("label"))
    return grouped.select(*out)
