"""Count-based sliding windows over ordered series.

Positions
---------
``positions`` gives every sample its 0-based position in its series and the
series length ``n``, ordered by ``(ts, tie)``.  A plain
``row_number() over (partition by series order by ts)`` runs a whole series
in one task, so one hot series (a third of all rows) would stall the job.
Instead rows are cut into time buckets of ``bucket_seconds`` (by default sized
from the data so the densest series-bucket holds about 2M samples):

1. a local ``row_number`` per ``(series, bucket)``  (one shuffle of the data);
2. per-bucket counts (map-side combined, one row per bucket) and their running
   sum per series give each bucket's offset (a window over the small table);
3. the offsets join back on ``(series, bucket)``; the rows are already hash
   partitioned on that key, so only the small side moves.

A bucket of one series holds at most ``rate * bucket_seconds`` samples, which
bounds every task independently of how the series are skewed; the automatic
width is refined from the measured peak count of any series bucket.

Windows
-------
A sample at ``pos`` lies in windows ``w`` with ``w*step <= pos < w*step+size``
and ``w < nwin`` where ``nwin = (n - size) // step + 1``.  Each sample is
exploded into its ``ceil(size/step)`` windows at most; a later
``groupBy(series, window_id)`` forms the windows.  Groups are bounded by
``size`` rows whatever the series length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strideframe.functions.ranking import bucketed_rank

DEFAULT_BUCKET_SECONDS = 86400


def window_step(size: int, overlap: float) -> int:
    """Step between window starts: ``int(size * (1 - overlap))``, at least 1."""
    if size < 1:
        raise ValueError("window size must be positive")
    return max(int(size * (1 - overlap)), 1)


def n_windows(n: int, size: int, overlap: float) -> int:
    """Number of complete windows in a series of length ``n`` (0 when too short)."""
    step = window_step(size, overlap)
    return 0 if n < size else (n - size) // step + 1


def auto_bucket_seconds(df: DataFrame, key: str, ts: str, target_rows: int = 1 << 21, max_rounds: int = 6) -> int:
    """Bucket width (a power of two seconds, 1 s to 1 day) whose densest ``(series, bucket)`` group
    holds at most about ``target_rows`` samples.

    Each round is one column-pruned, map-side-combined count per ``(series,
    bucket)`` at the current width; the width shrinks by the measured excess
    until the peak fits (bursty series may need a second round).
    """
    secs = F.unix_seconds(F.col(ts).cast("timestamp"))
    width = DEFAULT_BUCKET_SECONDS
    for _ in range(max_rounds):
        peak = (
            df.groupBy(key, F.floor(secs / width).alias("_b")).agg(F.count(F.lit(1)).alias("_c")).agg(F.max("_c")).first()[0]
            or 0
        )
        if peak <= target_rows or width == 1:
            return width
        shrunk = max(1, int(width * target_rows / peak))
        width = 1 << (shrunk.bit_length() - 1)
    return width


def positions(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    bucket_seconds: int | None = None,
) -> DataFrame:
    """Add ``pos`` (0-based, by ``ts, tie``) and ``n`` (series length) per ``key``.

    ``bucket_seconds=None`` sizes the time buckets from the data
    (``auto_bucket_seconds``); any width gives the same positions.
    """
    if bucket_seconds is None:
        bucket_seconds = auto_bucket_seconds(df, key, ts)
    bucket = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(bucket_seconds * 1_000_000))
    return bucketed_rank(df, [key], bucket, [ts, tie], rank_name="pos", size_name="n")


def window_ids(pos: Column, n: Column, size: int, step: int) -> Column:
    """Array of the window ids a sample at ``pos`` belongs to (may be empty)."""
    nwin = F.when(n >= size, F.floor((n - F.lit(size)) / F.lit(step)) + 1).otherwise(F.lit(0))
    lo = F.greatest(F.lit(0), F.ceil((pos - F.lit(size - 1)) / F.lit(step)))
    hi = F.least(F.floor(pos / F.lit(step)), nwin - 1)
    return F.when(lo <= hi, F.sequence(lo.cast("bigint"), hi.cast("bigint"))).otherwise(
        F.array().cast("array<bigint>")
    )


def assign_windows(
    df: DataFrame,
    size: int = 128,
    overlap: float = 0.5,
    on_short: str = "skip",
) -> DataFrame:
    """Explode positioned rows (needs ``pos`` and ``n``) into ``window_id`` and ``offset``.

    ``on_short='skip'`` drops series shorter than ``size`` (they have no window);
    ``'error'`` raises as the single-series reference does.
    """
    step = window_step(size, overlap)
    if on_short == "error":
        short = df.filter(F.col("n") < size).limit(1).count()
        if short:
            raise ValueError(f"a series is shorter than the window size ({size})")
    elif on_short != "skip":
        raise ValueError("on_short must be 'skip' or 'error'")
    return (
        df.filter(F.col("n") >= size)
        .withColumn("window_id", F.explode(window_ids(F.col("pos"), F.col("n"), size, step)))
        .withColumn("offset", (F.col("pos") - F.col("window_id") * step).cast("int"))
    )


def sliding_windows(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    size: int = 128,
    overlap: float = 0.5,
    bucket_seconds: int | None = None,
    on_short: str = "skip",
) -> DataFrame:
    """W1 from raw samples: positions then window explode."""
    return assign_windows(positions(df, key, ts, tie, bucket_seconds), size, overlap, on_short)


def window_stats(windowed: DataFrame, key: str, axes: list[str]) -> DataFrame:
    """Mean, population std, min and max per axis for every ``(series, window)``."""
    aggs = []
    for a in axes:
        aggs += [
            F.avg(a).alias(f"{a}_mean"),
            F.stddev_pop(a).alias(f"{a}_std"),
            F.min(a).alias(f"{a}_min"),
            F.max(a).alias(f"{a}_max"),
        ]
    return windowed.groupBy(key, "window_id").agg(*aggs)


def rolling_stats(
    positioned: DataFrame, key: str, col: str, length: int = 10, block: int = 4096
) -> DataFrame:
    """Trailing mean and sample std over ``length`` rows; incomplete frames dropped.

    Rows are framed by ``(series, pos // block)`` instead of the whole series, so a
    long series is spread over many tasks.  Each block also receives the last
    ``length - 1`` rows of the previous block (a halo, ``(length-1)/block`` extra
    rows) so frames that straddle a block edge are complete; halo rows are dropped
    after the frame is computed.
    """
    if length > block:
        raise ValueError("rolling length must not exceed the block size")
    own = F.floor(F.col("pos") / block)
    near_end = F.pmod(F.col("pos"), F.lit(block)) >= block - (length - 1)
    blocks = F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))
    placed = positioned.select(key, "pos", col, F.explode(blocks).alias("_blk")).withColumn("_halo", F.col("_blk") > own)
    w = Window.partitionBy(key, "_blk").orderBy("pos").rowsBetween(-(length - 1), 0)
    return (
        placed.select(
            key,
            "pos",
            "_halo",
            F.avg(col).over(w).alias("roll_mean"),
            F.stddev_samp(col).over(w).alias("roll_std"),
        )
        .filter(~F.col("_halo") & (F.col("pos") >= length - 1))
        .drop("_halo")
    )


def majority_label(windowed: DataFrame, key: str, label: str) -> DataFrame:
    """Most frequent label per window, ties to the smallest label."""
    return windowed.groupBy(key, "window_id").agg(F.mode(label, True).alias("label"))


def window_count_table(series_lengths: DataFrame, key: str, size: int, overlaps: list[float]) -> DataFrame:
    """Window count per series for several overlaps (integer arithmetic, no explode)."""
    table = F.array(*[F.struct(F.lit(float(o)).alias("overlap"), F.lit(window_step(size, o)).alias("step")) for o in overlaps])
    return series_lengths.select(key, "n", F.inline(table)).select(
        key,
        "overlap",
        "step",
        F.when(F.col("n") >= size, F.floor((F.col("n") - size) / F.col("step")) + 1)
        .otherwise(0)
        .cast("bigint")
        .alias("n_windows"),
    )
