import pytest
from pyspark.sql import functions as F

from strideframe.operators import windows


def _ramp(spark, n, key=1, parts=4):
    rows = [(key, i, i, float(i)) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, t long, id long, v double")
    return df.withColumn("ts", F.timestamp_seconds("t")).repartition(parts)


@pytest.mark.parametrize("overlap,expected", [(0.5, 7), (0.0, 4), (0.75, 13)])
def test_window_counts(spark, overlap, expected):
    w = windows.sliding_windows(_ramp(spark, 256), "k", "ts", "id", size=64, overlap=overlap)
    assert w.select("window_id").distinct().count() == expected
    assert windows.n_windows(256, 64, overlap) == expected


def test_second_window_starts_at_32(spark):
    w = windows.sliding_windows(_ramp(spark, 256), "k", "ts", "id", size=64, overlap=0.5)
    assert w.where("window_id = 1").agg(F.min("v")).first()[0] == 32.0
    assert w.where("window_id = 1").count() == 64


def test_step_clamped_and_short_series(spark):
    assert windows.window_step(4, 1.0) == 1
    df = _ramp(spark, 10)
    assert windows.sliding_windows(df, "k", "ts", "id", size=64).count() == 0
    with pytest.raises(ValueError):
        windows.sliding_windows(df, "k", "ts", "id", size=64, on_short="error")


def test_positions_span_many_buckets_and_partitions(spark):
    """A series cut into many time buckets still gets consecutive positions, whatever the partitioning."""
    df = _ramp(spark, 500)
    ref = None
    for parts in (1, 4, 16):
        pos = windows.positions(df.repartition(parts), "k", "ts", "id", bucket_seconds=7)
        got = sorted((r["id"], r["pos"], r["n"]) for r in pos.collect())
        assert [g[1] for g in got] == list(range(500))
        assert {g[2] for g in got} == {500}
        ref = ref or got
        assert got == ref


def test_rolling_across_block_edges(spark):
    df = windows.positions(_ramp(spark, 300), "k", "ts", "id")
    r = windows.rolling_stats(df, "k", "v", length=10, block=64).orderBy("pos").collect()
    assert len(r) == 291
    for row in r:
        assert row["roll_mean"] == pytest.approx(row["pos"] - 4.5)


def test_majority_label_ties_to_smallest(spark):
    rows = [(1, 0, i, lab) for i, lab in enumerate(["b", "a", "b", "a"])]
    df = spark.createDataFrame(rows, "k long, window_id long, offset int, label string")
    assert windows.majority_label(df, "k", "label").first()["label"] == "a"
