"""Results do not depend on how the input is partitioned (1, 4 and 16 partitions)."""

import pytest
from pyspark.sql import functions as F

from strideframe.operators import experiments, freqfeat, splits, windows
from strideframe.plans.catalog import round_floats

PARTS = (1, 4, 16)


def _events(spark, sf_small, parts):
    ev = spark.read.parquet(f"{sf_small}/events.parquet").repartition(parts)
    return ev.select("user_id", "ts", "event_id", F.col("value").alias("x"),
                     F.get_json_object("props", "$.k").cast("double").alias("y"), F.col("event_type").alias("label"))


def _rows(df):
    return sorted(tuple(r) for r in round_floats(df).collect())


def test_window_features_invariant(spark, sf_small):
    outs = []
    for p in PARTS:
        w = windows.sliding_windows(_events(spark, sf_small, p), "user_id", "ts", "event_id", 16, 0.5, bucket_seconds=3600)
        outs.append(_rows(freqfeat.extract_window_features(w, "user_id", ["x", "y"], 16, label="label")))
    assert outs[0] == outs[1] == outs[2] and len(outs[0]) > 0


def test_rolling_invariant(spark, sf_small):
    outs = []
    for p in PARTS:
        pos = windows.positions(_events(spark, sf_small, p), "user_id", "ts", "event_id", bucket_seconds=600)
        outs.append(_rows(windows.rolling_stats(pos, "user_id", "x", 10, block=16)))
    assert outs[0] == outs[1] == outs[2]


def test_splits_and_assignment_invariant(spark, sf_small):
    outs = []
    for p in PARTS:
        li = spark.read.parquet(f"{sf_small}/lineitem.parquet").repartition(p).select(
            F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("id"), "l_returnflag"
        )
        s = splits.stratified_split(li, "id", "l_returnflag")
        f = splits.kfold(li, "id", "l_returnflag", 5)
        a = li.select("id", experiments.assign_variant("id", {"a": 0.3, "b": 0.7}, 42).alias("v"))
        outs.append((_rows(s), _rows(f), _rows(a)))
    assert outs[0] == outs[1] == outs[2]


def test_hot_series_spread_over_buckets(spark):
    """One series holding most rows is ranked through many (series, bucket) groups, not one."""
    hot = spark.range(5000).select(F.lit(1).alias("k"), F.col("id").alias("id"), F.timestamp_seconds(F.col("id") * 60).alias("ts"))
    cold = spark.range(50).select((F.col("id") + 2).alias("k"), F.col("id"), F.timestamp_seconds(F.col("id") * 60).alias("ts"))
    pos = windows.positions(hot.unionByName(cold), "k", "ts", "id", bucket_seconds=3600)
    got = pos.where("k = 1").orderBy("id").select("pos").collect()
    assert [r[0] for r in got] == list(range(5000))
    buckets = hot.select(F.floor(F.unix_seconds("ts") / 3600)).distinct().count()
    assert buckets > 50


def test_auto_bucket_width_shrinks_for_dense_series(spark):
    dense = spark.range(20000).select(F.lit(1).alias("k"), F.col("id"), F.timestamp_seconds(F.col("id") / 100).alias("ts"))
    w = windows.auto_bucket_seconds(dense, "k", "ts", target_rows=1000)
    assert 1 <= w <= 16
    pos = windows.positions(dense, "k", "ts", "id")
    assert pos.agg(F.min("pos"), F.max("pos"), F.countDistinct("pos")).first() == (0, 19999, 20000)
