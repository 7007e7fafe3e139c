"""Window and feature queries on ``series``."""

from __future__ import annotations

from pyspark.sql import functions as F

from strideframe.operators import freqfeat, panes, timefeat, windows
from strideframe.plans.catalog import register, with_ctes
from strideframe.sources.tables import read_table
from strideframe.plans.derived import SQL_SERIES, series, sql_windowed

# Fixed query parameters: the driver's series have 49 to 88 samples, so the
# reference default of 128 would give no window.
SIZE = 16
OVERLAP = 0.5
STEP = windows.window_step(SIZE, OVERLAP)
RATE = 50.0
N_COEFFS = 10
AXES = ["x", "y"]
N_BINS = SIZE // 2 + 1
KEY = "user_id"

SQL_WIN = with_ctes(SQL_SERIES, sql_windowed(SIZE, STEP))


def windowed(spark, d):
    return windows.assign_windows(series(spark, d), SIZE, OVERLAP)


def features(spark, d, time_domain=True, frequency_domain=True, label=True):
    return freqfeat.extract_window_features(
        windowed(spark, d),
        KEY,
        AXES,
        SIZE,
        RATE,
        N_COEFFS,
        time_domain=time_domain,
        frequency_domain=frequency_domain,
        label="label" if label else None,
        centre_zcr=True,
    )


# ------------------------------------------------------------------ SQL pieces
def _sql_time_aggs(a: str) -> str:
    return f"""avg({a}) AS mean_{a}, stddev_pop({a}) AS std_{a}, min({a}) AS min_{a}, max({a}) AS max_{a},
       max({a}) - min({a}) AS range_{a}, median({a}) AS median_{a}, avg({a} * {a}) AS energy_{a},
       quantile_cont({a}, 0.75) - quantile_cont({a}, 0.25) AS iqr_{a}"""


SQL_LABEL = """lab AS (
  SELECT user_id, window_id, label FROM (
    SELECT user_id, window_id, label,
           row_number() OVER (PARTITION BY user_id, window_id ORDER BY count(*) DESC, label) AS rk
    FROM win GROUP BY user_id, window_id, label) WHERE rk = 1)"""


def _sql_zcr(a: str) -> str:
    return f"""zc_{a} AS (
  SELECT user_id, window_id,
         CASE WHEN count(*) < 2 THEN 0.0
              ELSE count_if(prev IS NOT NULL AND prev <> sg) / (count(*) - 1) END AS zcr_{a}
  FROM (SELECT user_id, window_id, sign(c) AS sg,
               lag(sign(c)) OVER (PARTITION BY user_id, window_id ORDER BY "offset") AS prev
        FROM (SELECT user_id, window_id, "offset",
                     {a} - avg({a}) OVER (PARTITION BY user_id, window_id) AS c FROM win))
  GROUP BY user_id, window_id)"""


def _sql_entropy(a: str) -> str:
    return f"""en_{a} AS (
  SELECT m.user_id, m.window_id,
         CASE WHEN m.mx = m.mn THEN 0.0 ELSE -sum(h.c / m.n * ln(h.c / m.n + 1e-10)) END AS entropy_{a}
  FROM (SELECT user_id, window_id, min({a}) AS mn, max({a}) AS mx, count(*) AS n FROM win GROUP BY ALL) m
  LEFT JOIN (SELECT w.user_id, w.window_id, least(floor((w.{a} - q.mn) / (q.mx - q.mn) * 10), 9) AS bin,
                    count(*) AS c
             FROM win w JOIN (SELECT user_id, window_id, min({a}) AS mn, max({a}) AS mx FROM win GROUP BY ALL) q
               ON w.user_id = q.user_id AND w.window_id = q.window_id
             WHERE q.mx > q.mn GROUP BY ALL) h
    ON h.user_id = m.user_id AND h.window_id = m.window_id
  GROUP BY m.user_id, m.window_id, m.mn, m.mx)"""


def _sql_dft(a: str) -> str:
    return f"""dft_{a} AS (
  SELECT w.user_id, w.window_id, t.k,
         sqrt(pow(sum(w.{a} * cos(2 * pi() * t.k * t.o / {SIZE})), 2)
              + pow(sum(w.{a} * sin(2 * pi() * t.k * t.o / {SIZE})), 2)) AS mag
  FROM win w JOIN (SELECT o.range AS o, k.range AS k FROM range({SIZE}) o, range({N_BINS}) k) t
    ON w."offset" = t.o
  GROUP BY w.user_id, w.window_id, t.k)"""


def _sql_freq(a: str) -> str:
    coeffs = ",\n         ".join(
        f"max(CASE WHEN k = {j} THEN mag END) AS fft_coeff_{j}_{a}" for j in range(min(N_COEFFS, N_BINS))
    )
    return f"""fq_{a} AS (
  SELECT user_id, window_id,
         arg_max(k, (mag, -k)) FILTER (WHERE k >= 1) * {RATE / SIZE} AS dominant_freq_{a},
         sum(mag * mag) AS spectral_energy_{a},
         {coeffs},
         -sum((mag * mag / (tot + 1e-10)) * ln(mag * mag / (tot + 1e-10) + 1e-10)) AS spectral_entropy_{a},
         sum(k * {RATE / SIZE} * mag) / (sum(mag) + 1e-10) AS spectral_centroid_{a}
  FROM (SELECT *, sum(mag * mag) OVER (PARTITION BY user_id, window_id) AS tot FROM dft_{a})
  GROUP BY user_id, window_id)"""


def _time_cols(a):
    return [f"{s}_{a}" for s in ("mean", "std", "min", "max", "range", "median", "zcr", "energy", "iqr", "entropy")]


def _freq_cols(a):
    return (
        [f"dominant_freq_{a}", f"spectral_energy_{a}"]
        + [f"fft_coeff_{j}_{a}" for j in range(min(N_COEFFS, N_BINS))]
        + [f"spectral_entropy_{a}", f"spectral_centroid_{a}"]
    )


CROSS = ["sma", "magnitude_mean", "magnitude_std"]
TIME_COLS = [c for a in AXES for c in _time_cols(a)] + CROSS
FREQ_COLS = [c for a in AXES for c in _freq_cols(a)]
ENERGY_BITS = {f"spectral_energy_{a}": 8 for a in AXES} | {f"energy_{a}": 16 for a in AXES}


def _sql_full(time_domain=True, frequency_domain=True, label=True, cols=None):
    ctes = [SQL_SERIES, sql_windowed(SIZE, STEP)]
    base = f"""tb AS (
  SELECT user_id, window_id, {", ".join(_sql_time_aggs(a) for a in AXES)},
         avg((abs(x) + abs(y)) / 2) AS sma,
         avg(sqrt(x * x + y * y)) AS magnitude_mean, stddev_pop(sqrt(x * x + y * y)) AS magnitude_std
  FROM win GROUP BY user_id, window_id)"""
    ctes.append(base)
    joins = ""
    if time_domain:
        for a in AXES:
            ctes += [_sql_zcr(a), _sql_entropy(a)]
            joins += f" JOIN zc_{a} USING (user_id, window_id) JOIN en_{a} USING (user_id, window_id)"
    if frequency_domain:
        for a in AXES:
            ctes += [_sql_dft(a), _sql_freq(a)]
            joins += f" JOIN fq_{a} USING (user_id, window_id)"
    if label:
        ctes.append(SQL_LABEL)
        joins += " JOIN lab USING (user_id, window_id)"
    if cols is None:
        cols = (TIME_COLS if time_domain else []) + (FREQ_COLS if frequency_domain else []) + (["label"] if label else [])
    return with_ctes(*ctes) + f"SELECT user_id, window_id, {', '.join(cols)} FROM tb{joins}"


# ------------------------------------------------------------------ W1-W5
@register(
    "w1_sliding_windows",
    SQL_WIN + 'SELECT user_id, window_id, "offset", pos, x FROM win',
    floats=["x"],
)
def w1_sliding_windows(spark, d):
    return windowed(spark, d).select("user_id", "window_id", "offset", "pos", "x")


@register(
    "w1_positions",
    with_ctes(SQL_SERIES) + "SELECT user_id, event_id, pos, n FROM series",
)
def w1_positions(spark, d):
    return series(spark, d).select("user_id", "event_id", "pos", "n")


_W2_FLOATS = [f"{a}_{s}" for a in AXES for s in ("mean", "std", "min", "max")]


@register(
    "w2_window_stats",
    SQL_WIN
    + "SELECT user_id, window_id, "
    + ", ".join(
        f"avg({a}) AS {a}_mean, stddev_pop({a}) AS {a}_std, min({a}) AS {a}_min, max({a}) AS {a}_max" for a in AXES
    )
    + " FROM win GROUP BY user_id, window_id",
    floats=_W2_FLOATS,
)
def w2_window_stats(spark, d):
    return panes.window_stats(series(spark, d), KEY, AXES, SIZE, OVERLAP)


DENSE = 0.75


@register(
    "w2_dense_windows",
    with_ctes(SQL_SERIES, sql_windowed(SIZE, windows.window_step(SIZE, DENSE)))
    + "SELECT user_id, window_id, "
    + ", ".join(
        f"avg({a}) AS {a}_mean, stddev_pop({a}) AS {a}_std, min({a}) AS {a}_min, max({a}) AS {a}_max" for a in AXES
    )
    + " FROM win GROUP BY user_id, window_id",
    floats=_W2_FLOATS,
)
def w2_dense_windows(spark, d):
    """Windows that begin every fourth sample: each sample is shuffled once, as in its pane's moments."""
    return panes.window_stats(series(spark, d), KEY, AXES, SIZE, DENSE)


@register(
    "w3_rolling_stats",
    with_ctes(SQL_SERIES)
    + """SELECT user_id, pos, roll_mean, roll_std FROM (
  SELECT user_id, pos,
         avg(x) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS roll_mean,
         stddev_samp(x) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS roll_std
  FROM series) WHERE pos >= 9""",
    floats=["roll_mean", "roll_std"],
)
def w3_rolling_stats(spark, d):
    return windows.rolling_stats(series(spark, d), KEY, "x", 10)


@register("w4_majority_label", SQL_WIN + SQL_LABEL.replace("lab AS (", "SELECT * FROM (", 1))
def w4_majority_label(spark, d):
    return windows.majority_label(windowed(spark, d), KEY, "label")


W5_OVERLAPS = [0.0, 0.25, 0.5, 0.75]


@register(
    "w5_window_counts",
    with_ctes(SQL_SERIES)
    + f"""SELECT s.user_id, o.overlap, o.step,
       CAST(CASE WHEN s.n >= {SIZE} THEN floor((s.n - {SIZE}) / o.step) + 1 ELSE 0 END AS BIGINT) AS n_windows
FROM (SELECT DISTINCT user_id, n FROM series) s,
     (VALUES {", ".join(f"({o}, {windows.window_step(SIZE, o)})" for o in W5_OVERLAPS)}) o(overlap, step)""",
    floats=["overlap"],
)
def w5_window_counts(spark, d):
    lengths = read_table(spark, d, "events").groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    return windows.window_count_table(lengths, KEY, SIZE, W5_OVERLAPS)


# ------------------------------------------------------------------ T1-T7 (+W4 label: the flagship)
_T1 = [f"{s}_{a}" for a in AXES for s in ("mean", "std", "min", "max", "range", "median")]


@register("t1_time_stats", _sql_full(True, False, True, _T1 + ["label"]), floats=_T1)
def t1_time_stats(spark, d):
    return features(spark, d, True, False, True).select(KEY, "window_id", *_T1, "label")


def _time_query(name, cols, bits=None, moments=False):
    """``moments``: the columns follow from the moments of panes."""

    @register(name, _sql_full(True, False, False, cols), floats=cols, bits=bits)
    def q(spark, d):
        if moments:
            return panes.window_signals(series(spark, d), KEY, AXES, SIZE, OVERLAP).select(KEY, "window_id", *cols)
        return features(spark, d, True, False, False).select(KEY, "window_id", *cols)

    return q


_time_query("t2_zero_crossing_rate", [f"zcr_{a}" for a in AXES])
_time_query("t3_energy", [f"energy_{a}" for a in AXES], ENERGY_BITS, moments=True)
_time_query("t4_iqr", [f"iqr_{a}" for a in AXES])
_time_query("t5_entropy", [f"entropy_{a}" for a in AXES])
_time_query("t6_sma", ["sma"], moments=True)
_time_query("t7_magnitude", ["magnitude_mean", "magnitude_std"], moments=True)


# ------------------------------------------------------------------ F1-F7
@register(
    "f1_spectrum",
    with_ctes(SQL_SERIES, sql_windowed(SIZE, STEP), _sql_dft("x"))
    + "SELECT user_id, window_id, k, mag AS mag_x FROM dft_x",
    floats=["mag_x"],
)
def f1_spectrum(spark, d):
    w = windowed(spark, d).groupBy(KEY, "window_id").agg(timefeat.collect_sorted(["x"]).alias("_w"))
    mags = w.select(KEY, "window_id", freqfeat.rfft_magnitude(timefeat.ordered_values(F.col("_w"), "x")).alias("m"))
    return mags.select(KEY, "window_id", F.posexplode("m").alias("k", "mag_x")).withColumn("k", F.col("k").cast("bigint"))


@register(
    "f1_spectrum_native",
    with_ctes(SQL_SERIES, sql_windowed(SIZE, STEP), _sql_dft("x"))
    + "SELECT user_id, window_id, k, mag AS mag_x FROM dft_x",
    floats=["mag_x"],
)
def f1_spectrum_native(spark, d):
    s = freqfeat.spectrum_dft(windowed(spark, d), KEY, "x", SIZE)
    return s.select(KEY, "window_id", F.col("k").cast("bigint").alias("k"), F.col("mag").alias("mag_x"))


def _freq_query(name, cols, bits=None):
    @register(name, _sql_full(False, True, False, cols), floats=cols, bits=bits)
    def q(spark, d):
        return features(spark, d, False, True, False).select(KEY, "window_id", *cols)

    return q


_freq_query("f2_dominant_frequency", [f"dominant_freq_{a}" for a in AXES])
_freq_query("f3_spectral_energy", [f"spectral_energy_{a}" for a in AXES], ENERGY_BITS)
_freq_query("f4_fft_coefficients", [f"fft_coeff_{j}_{a}" for a in AXES for j in range(min(N_COEFFS, N_BINS))])
_freq_query("f5_spectral_entropy", [f"spectral_entropy_{a}" for a in AXES])
_freq_query("f6_spectral_centroid", [f"spectral_centroid_{a}" for a in AXES])


@register("f7_window_features", _sql_full(True, True, True), floats=TIME_COLS + FREQ_COLS, bits=ENERGY_BITS)
def f7_window_features(spark, d):
    return features(spark, d, True, True, True)
