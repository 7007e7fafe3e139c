import pytest
from pyspark.sql import functions as F

from strideframe.operators import experiments, prep, splits


def _labelled(spark, n=1000, parts=4):
    rows = [(i, ["a", "b", "c"][i % 3] if i % 10 else "d", i % 37) for i in range(n)]
    return spark.createDataFrame(rows, "id long, label string, grp long").repartition(parts)


def test_stratified_split_sizes_and_disjoint(spark):
    df = splits.stratified_split(_labelled(spark), "id", "label", 0.15, 0.15, 42)
    assert df.count() == 1000
    assert df.select("id").distinct().count() == 1000
    per = {(r["label"], r["split"]): r["count"] for r in df.groupBy("label", "split").count().collect()}
    n_a = sum(v for (lab, _), v in per.items() if lab == "a")
    assert per[("a", "test")] == -(-n_a * 15 // 100)


def test_split_independent_of_partitioning(spark):
    a = {r["id"]: r["split"] for r in splits.stratified_split(_labelled(spark, parts=1), "id", "label").collect()}
    b = {r["id"]: r["split"] for r in splits.stratified_split(_labelled(spark, parts=16), "id", "label").collect()}
    assert a == b


def test_group_split_keeps_groups_whole(spark):
    df = splits.group_split(_labelled(spark), "grp", 0.2, 0.2, 42)
    assert df.groupBy("grp").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    groups = {r["split"]: r["n"] for r in df.groupBy("split").agg(F.count_distinct("grp").alias("n")).collect()}
    assert groups["test"] == 7 and groups["val"] == 6


def test_kfold_and_sample(spark):
    f = splits.kfold(_labelled(spark), "id", "label", 5, 42)
    sizes = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 4
    assert splits.sample_n(_labelled(spark), "id", 30).count() == 30


def test_balanced_resample_equal_class_shares(spark):
    r = splits.balanced_resample(_labelled(spark), "id", "label", n_draws=400)
    counts = [c["count"] for c in r.groupBy("label").count().collect()]
    assert counts == [100] * 4


@pytest.mark.parametrize("weights,lo,hi", [({"a": 0.5, "b": 0.5}, 400, 600), ({"a": 0.8, "b": 0.2}, 700, 900)])
def test_traffic_split_bounds(spark, weights, lo, hi):
    ids = spark.createDataFrame([(f"user_{i}",) for i in range(1000)], "id string")
    a = ids.where(experiments.assign_variant("id", weights, 42) == "a").count()
    assert lo <= a <= hi


def test_weights_must_sum_to_one():
    with pytest.raises(ValueError):
        experiments.thresholds({"a": 0.5, "b": 0.6})


def test_scalers_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0, "train"), (3.0, 5.0, "train"), (10.0, 5.0, "test")], "x double, c double, split string")
    out = prep.scale_by_split(df, ["x", "c"], "standard").collect()
    assert [r["x"] for r in out[:2]] == [-1.0, 1.0]
    assert [r["c"] for r in out] == [0.0, 0.0, 0.0]
    mm = prep.scale_by_split(df, ["x", "c"], "minmax").collect()
    assert [r["x"] for r in mm] == [0.0, 1.0, 4.5]
    assert [r["c"] for r in mm] == [0.0, 0.0, 0.0]


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "y string")
    w = {r["y"]: r["weight"] for r in prep.class_weights(df, "y").collect()}
    assert w["a"] == pytest.approx(4 / 6) and w["b"] == pytest.approx(2.0)
    with pytest.raises(ValueError):
        prep.class_weights(df, "y", "other")


def test_label_encoding_alphabetical(spark):
    df = spark.createDataFrame([("WALKING",), ("LAYING",), ("SITTING",)], "activity string")
    enc = {r["activity"]: r["label_idx"] for r in prep.encode_labels(df, prep.pick_label_column(df)).collect()}
    assert enc == {"LAYING": 0, "SITTING": 1, "WALKING": 2}
