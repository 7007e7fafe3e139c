import pytest
from pyspark.sql import functions as F

from strideframe.operators import naming, runs


def _log(spark, seqs):
    rows = [(rid, e, float(l)) for rid, seq in seqs.items() for e, l in enumerate(seq)]
    return spark.createDataFrame(rows, "run_id string, epoch long, loss double")


def test_early_stop(spark):
    out = {r["run_id"]: r for r in runs.early_stop(_log(spark, {"dec": [1.0, 0.9, 0.8], "flat": [1, 1, 1, 1], "dip": [1, 1, 0.5]}), 3).collect()}
    assert out["dec"]["stop_epoch"] is None
    assert out["flat"]["stop_epoch"] == 3 and out["flat"]["best_epoch"] == 0
    assert out["dip"]["stop_epoch"] is None and out["dip"]["best_epoch"] == 2


def test_dedupe_names(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(["a", "b", "a", "a", "c", "b"])], "pos long, name string")
    got = [r["unique_name"] for r in naming.dedupe_names(df, "name", "pos", range_bits=1).orderBy("pos").collect()]
    assert got == ["a", "b", "a_1", "a_2", "c", "b_1"]


def test_categorize_and_groups(spark):
    names = ["tGravityAcc-mean()-X", "tBodyAccJerk-std()-Y", "fBodyAcc-mad()-Z", "tBodyGyroJerk-max()-X",
             "fBodyGyro-min()-Y", "angle(X,gravityMean)", "other"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    cats = [r[0] for r in df.select(naming.categorize(F.col("name"))).collect()]
    assert cats == ["Gravity Acc", "Body Acc Jerk", "Body Acc", "Gyro Jerk", "Gyro", "Angle", "Other"]
    groups = df.select(naming.importance_groups(F.col("name")).alias("g")).collect()
    assert set(groups[0]["g"]) == {"gravity_acceleration", "mean_features"}
    assert "frequency_domain" in groups[2]["g"]
    with pytest.raises(ValueError):
        naming.subset_predicate(F.col("name"), "nope")


def test_reshape(spark):
    df = spark.createDataFrame([(list(map(float, range(18))),)], "v array<double>")
    seq = df.select(naming.reshape_sequence(F.col("v"), 6, 3).alias("s")).first()["s"]
    assert len(seq) == 6 and seq[1] == [3.0, 4.0, 5.0]
    bad = spark.createDataFrame([(list(map(float, range(20))),)], "v array<double>")
    with pytest.raises(Exception):
        bad.select(naming.reshape_sequence(F.col("v"), 10, 3)).collect()


def test_roll(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0],)], "v array<double>")
    assert df.select(naming.roll(F.col("v"), F.lit(1))).first()[0] == [4.0, 1.0, 2.0, 3.0]
    assert df.select(naming.roll(F.col("v"), F.lit(-1))).first()[0] == [2.0, 3.0, 4.0, 1.0]


def test_best_version_strict_and_unknown_model(spark):
    from strideframe.operators import learn

    v = spark.createDataFrame([("m", 1, None), ("m", 2, None)], "name string, version int, acc double")
    assert runs.best_version(v, "acc").count() == 0
    with pytest.raises(ValueError):
        runs.best_version(v, "acc", strict=True)
    with pytest.raises(ValueError):
        learn.make_estimator("svm")


def test_blocked_early_stop_equals_fold(spark):
    import random

    rng = random.Random(3)
    seqs = {}
    for r in range(40):
        n = rng.randint(1, 60)
        cur, seq = 5.0, []
        for _ in range(n):
            cur += rng.choice([-0.3, -0.01, 0.0, 0.2, -0.002])
            seq.append(round(cur, 3))
        seqs[f"r{r}"] = seq
    log = _log(spark, seqs)
    for patience in (1, 3, 5):
        a = sorted(tuple(r) for r in runs.early_stop(log, patience, 0.005, block=7).collect())
        b = sorted(tuple(r) for r in runs.early_stop_fold(log, patience, 0.005).collect())
        assert a == b
