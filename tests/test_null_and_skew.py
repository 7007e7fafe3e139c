"""Rows with NULL keys stay; far-out values, ties and large counts do not break a plan or a result."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from strideframe.functions.cuts import below, cut_table
from strideframe.functions.nullsafe import join_by
from strideframe.functions.quantiles import exact_quantiles
from strideframe.functions.ranking import prefix_below
from strideframe.operators import correlate, evaluate, experiments, naming, prep, runs, scoring, splits, stats, windows
from strideframe.operators.preprocess import Preprocessor
from strideframe.session import checkpoint_dir
from strideframe.streaming import streams as st


@pytest.fixture(scope="module")
def with_nulls(spark):
    rows = [(i, None if i % 4 == 0 else f"c{i % 3}", float(i)) for i in range(100)]
    return spark.createDataFrame(rows, "id long, label string, x double")


def test_splits_keep_null_labels(with_nulls):
    split = splits.stratified_split(with_nulls, "id", "label")
    assert split.count() == 100
    assert split.where("label is null").select("split").distinct().count() == 3
    assert splits.kfold(with_nulls, "id", "label", 5).count() == 100
    assert splits.group_split(with_nulls, "label").count() == 100
    draws = splits.balanced_resample(with_nulls, "id", "label", 400)
    shares = {r["label"]: r["count"] for r in draws.groupBy("label").count().collect()}
    assert sum(shares.values()) == 400 and set(shares) == {None, "c0", "c1", "c2"} and set(shares.values()) == {100}


def test_positions_and_joins_keep_null_series(spark, with_nulls):
    ev = with_nulls.select(F.col("label").alias("k"), F.timestamp_seconds("id").alias("ts"), "id", "x")
    placed = windows.positions(ev, "k", "ts", "id")
    assert placed.count() == 100
    nulls = sorted(r["pos"] for r in placed.where("k is null").collect())
    assert nulls == list(range(25))
    weights = prep.class_weights(with_nulls, "label")
    weighted = prep.sample_weights(with_nulls, "label", weights)
    assert weighted.count() == 100 and weighted.where("weight is null").count() == 0
    names = spark.createDataFrame([("a", 0), (None, 1), (None, 2)], "name string, pos long")
    assert naming.dedupe_names(names, "name", "pos").count() == 3
    assert join_by(with_nulls, with_nulls.groupBy("label").count(), ["label"]).count() == 100


def test_quantiles_with_nulls_nan_outliers_and_ties(spark, monkeypatch):
    rng = np.random.default_rng(3)
    values = {"u": rng.random(30_000).tolist() + [1e9], "t": [5.0] * 20_000 + rng.random(10_000).tolist(), None: [1.0, 2.0, 3.0, float("nan")], "one": [7.0]}
    rows = [(g, float(v)) for g, vs in values.items() for v in vs] + [("u", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    want = {(g, p): np.quantile([v for v in vs if v == v], p) for g, vs in values.items() for p in probs}
    for most in (2_000_000, 10):  # brackets, then the path over ranges
        monkeypatch.setattr("strideframe.functions.quantiles.MOST_INSIDE", most)
        got = {(r["g"], r["p"]): r["q"] for r in exact_quantiles(df, ["g"], "v", probs).collect()}
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_ranges_are_even_with_one_far_out_value(spark):
    df = spark.range(20_000).select(F.lit("a").alias("g"), (F.col("id") / 20_000).alias("v")).unionByName(spark.createDataFrame([("a", 1e9)], "g string, v double"))
    table = cut_table(df, ["g"], "v", rows_per_range=1000)
    sizes = [r["count"] for r in df.join(table, "g").groupBy(below(F.col("_cuts"), F.col("v"))).count().collect()]
    assert len(sizes) >= 19 and max(sizes) <= 2000
    got = prefix_below(df.withColumn("one", F.lit(1)), ["g"], "v", ["one"], rows_per_range=1000)
    assert got.where(F.col("v") < 1).where(F.abs(F.col("one_below") - F.col("v") * 20_000) > 0.5).count() == 0


def test_mutual_information_with_ties(spark):
    rng = np.random.default_rng(5)
    x = np.where(rng.random(900) < 0.34, 1.0, rng.random(900).round(2))
    y = (x + rng.random(900) * 0.3 > 0.6).astype(int)
    df = spark.createDataFrame([("f", int(b), float(a)) for a, b in zip(x, y, strict=True)], "feature string, label int, value double")
    got = correlate.binned_mutual_information(df, "feature", "label", "value").first()["mi"]
    bins = np.floor(np.array([(x < v).sum() for v in x]) * 10 / len(x))
    want = 0.0
    for b in np.unique(bins):
        for c in (0, 1):
            pxy = ((bins == b) & (y == c)).mean()
            if pxy:
                want += pxy * np.log(pxy / ((bins == b).mean() * (y == c).mean()))
    assert got == pytest.approx(want)


def test_describe_leaves_nan_out(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),), (None,)], "v double")
    r = stats.describe(df, ["v"]).first()
    assert (r["count"], r["mean"], r["p50"], r["max"]) == (3, 2.0, 2.0, 3.0)


def test_large_counts_do_not_overflow(spark):
    metrics = spark.createDataFrame([("a", 5_000_000_000, 2_500_000_000), ("b", 5_000_000_000, 2_500_100_000), ("c", 0, 0)], "variant string, n long, correct long")
    rows = {r["treatment"]: r for r in experiments.ab_result(metrics).collect()}
    assert set(rows) == {"b", "c"}
    assert rows["b"]["chi2"] == pytest.approx(4.0, rel=0.01) and rows["b"]["significant"]
    assert not experiments.ab_result(metrics, "a", 0.99).where("treatment = 'b'").first()["significant"]
    with pytest.raises(ValueError):
        experiments.chi2_critical(1.0)
    scores = spark.createDataFrame([(1, 1, 0.9), (0, 1, 0.2)], "y_true int, cls int, p double")
    assert evaluate.roc_auc_by_class(scores).first()["auc"] == 1.0


def test_empty_fits(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    assert prep.fit_scaler(df, ["a", "b"])["b"] == (0.0, 1.0)
    assert prep.apply_scaler(df, prep.fit_scaler(df, ["a", "b"])).where("b is not null").count() == 0
    with pytest.raises(ValueError):
        prep.fit_scaler(df.limit(0), ["a"])


def test_twelve_classes_and_wide_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=80).tolist(), i % 12) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    long = df.select("vec_id", "label", F.posexplode("embedding").alias("pos", "val"))
    fitted = scoring.fit_centroids(long)
    assert set(fitted) == set(range(12)) and all(len(v) == 80 for v in fitted.values())
    pred = df.select("label", scoring.nearest_centroid(F.col("embedding"), fitted).alias("p"))
    centres = np.array([fitted[c] for c in range(12)])
    want = [int(((centres - np.array(v)) ** 2).sum(axis=1).argmin()) for _, v, _ in rows]
    assert [r["p"] for r in pred.collect()] == want
    m = df.select(naming.vector_magnitude("embedding").alias("m")).collect()
    assert np.allclose([r["m"] for r in m], [np.linalg.norm(v) for _, v, _ in rows])


def test_sample_n_and_membership(spark):
    df = spark.range(5000).withColumn("g", (F.col("id") % 7).cast("string"))
    for n in (0, 1, 77, 5000, 9000):
        assert splits.sample_n(df, "id", n).count() == min(n, 5000)
    keys = spark.createDataFrame([("1",), ("3",)], "g string")
    assert splits.with_membership(df, keys, "g").where("is_member").select("g").distinct().count() == 2


def test_early_stop_with_gaps_and_null_run(spark):
    losses = [1.0, 0.9, 0.95, 0.8, 0.8, 0.8, 0.8, 0.1]
    rows = [(r, 3 * e + 5, x) for r in ("a", None) for e, x in enumerate(losses)]
    log = spark.createDataFrame(rows, "run_id string, epoch long, loss double")
    for block in (4, 65536):
        got = runs.early_stop(log, 3, 0.001, block).collect()
        assert len(got) == 2
        assert {(r["stop_epoch"], r["best_epoch"], r["best_loss"]) for r in got} == {(23, 14, 0.8)}


def test_preprocessor_by_mutual_information_and_labels(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "ab"[i % 2], float(i % 2) + rng.normal() * 0.1, rng.normal()) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, label string, good double, noise double")
    pre = Preprocessor(n_select_features=1)
    out = pre.fit_transform(df, "id", "label", ["good", "noise"])
    assert pre.selected_features == ["good"] and out.count() == 200
    again = pre.transform(df.drop("label"))
    assert again.columns[-1] == "good"
    numbered = pre.encode_labels(df, "label")
    back = pre.inverse_transform_labels(numbered, "label_idx", "back")
    assert back.where("back <> label or back is null").count() == 0
    with pytest.raises(ValueError):
        Preprocessor().transform(df)


def test_late_samples_are_counted(spark):
    folder = tempfile.mkdtemp(prefix="sf-late-")
    for i, ids in enumerate(([0, 1, 2, 6, 7], [3, 8, 9], [4, 5, 10, 11])):
        part = spark.createDataFrame([(1, k, float(k)) for k in ids], "user_id long, event_id long, value double")
        part = part.withColumn("ts", F.timestamp_seconds("event_id")).coalesce(1)
        part.write.parquet(os.path.join(folder, f"d{i}"))
        stamp = 1_700_000_000 + i
        for name in os.listdir(os.path.join(folder, f"d{i}")):
            os.utime(os.path.join(folder, f"d{i}", name), (stamp, stamp))
    schema = spark.read.parquet(os.path.join(folder, "d0")).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)
    make = lambda s: st.stream_windows(s, "user_id", "ts", "event_id", "value", 4, 0.5, "0 seconds")
    got = st.run_to_end(make, stream, "ts", "late").collect()
    assert sum(r["n"] for r in got if r["window_id"] == st.LATE) == 3
    seen = [0, 1, 2, 6, 7, 8, 9, 10, 11]
    found = {r["window_id"]: r for r in got if r["window_id"] != st.LATE}
    assert sorted(found) == [0, 1, 2]
    for w, r in found.items():
        x = np.array(seen[2 * w : 2 * w + 4], float)
        assert (r["mean_x"], r["std_x"], r["median_x"], r["range_x"]) == pytest.approx((x.mean(), x.std(), np.median(x), x.max() - x.min()))


def test_checkpoint_folder_needs_a_setting_off_local_masters(spark):
    class Conf:
        def get(self, *_):
            return None

    class Fake:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Fake())


def test_subsets_of_a_wide_frame(spark):
    df = spark.createDataFrame([(1.0,) * 4], "`tBodyAcc-X` double, `fBodyAcc-X` double, `tGyro-Y` double, angle double")
    assert naming.select_subset(df, "all").columns == df.columns
    assert naming.select_subset(df, "time").columns == ["tBodyAcc-X", "tGyro-Y"]
    assert naming.select_subset(df, "body_acc").columns == ["tBodyAcc-X", "fBodyAcc-X"]
    assert naming.select_subset(df, "gyro").columns == ["tGyro-Y"]
    with pytest.raises(ValueError):
        naming.select_subset(df, "other")
