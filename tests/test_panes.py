"""Window statistics from panes equal those of exploded windows, whatever size, overlap and block."""

import random

import pytest
from pyspark.sql import functions as F

from strideframe.operators import panes, timefeat, windows


def samples(spark, offset=0.0):
    rng = random.Random(3)
    rows = [(u, p, n, rng.gauss(offset, 1), None if rng.random() < 0.05 else rng.gauss(0, 5)) for u, n in ((1, 100), (2, 16), (3, 15), (None, 64)) for p in range(n)]
    return spark.createDataFrame(rows, "u long, pos long, n long, x double, y double").repartition(5)


@pytest.mark.parametrize(("size", "overlap", "block"), [(16, 0.5, 8192), (16, 0.75, 4), (12, 0.4, 7), (10, 0.9, 3), (5, 0.0, 1), (7, 0.5, 8192)])
def test_panes_equal_windows(spark, size, overlap, block):
    df = samples(spark)
    axes = ["x", "y"]
    win = windows.assign_windows(df, size, overlap)
    aggs = [c for a in axes for c in timefeat.axis_aggregates(a)] + timefeat.cross_axis_aggregates(axes)
    want = {(r["u"], r["window_id"]): r.asDict() for r in win.groupBy("u", "window_id").agg(*aggs).collect()}
    got = {(r["u"], r["window_id"]): r.asDict() for r in panes.window_signals(df, "u", axes, size, overlap, block).collect()}
    assert set(got) == set(want) and want
    for k, row in want.items():
        for name, v in row.items():
            assert got[k][name] == (v if v is None or isinstance(v, int) else pytest.approx(v, rel=1e-9, abs=1e-9)), (k, name)
    stats = panes.window_stats(df, "u", axes, size, overlap, block)
    assert stats.columns == windows.window_stats(win, "u", axes).columns and stats.count() == len(want)


def test_panes_keep_the_digits_of_a_large_offset(spark):
    df = samples(spark, 1e8)
    exact = {(r["u"], r["window_id"]): r["std_x"] for r in windows.assign_windows(df, 16, 0.5).groupBy("u", "window_id").agg(*timefeat.axis_aggregates("x")).collect()}
    got = {(r["u"], r["window_id"]): r["std_x"] for r in panes.window_signals(df, "u", ["x"], 16, 0.5).collect()}
    assert all(abs(got[k] - exact[k]) < 1e-6 for k in exact)


def test_panes_shuffle_moments_only(spark):
    df = samples(spark)
    plan = panes.window_stats(df, "u", ["x"], 16, 0.75)._jdf.queryExecution().executedPlan().toString()
    assert "window_ids" not in plan and plan.count("Generate") <= 1
    assert panes.window_stats(df.limit(0), "u", ["x"], 16, 0.75).count() == 0
    assert panes.pane_moments(df, "u", {"x": F.col("x")}, 16, 0.75).count() == 25 + 4 + 4 + 16
