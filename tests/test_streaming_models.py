import os
import tempfile

import pytest
from pyspark.sql import functions as F

from strideframe.operators import learn, scoring
from strideframe.plans import models
from strideframe.streaming import streams as st


def test_stream_windows_equal_batch_over_many_micro_batches(spark, sf_small):
    """Events arrive day by day (one file per micro-batch); state carries windows across batches."""
    ev = spark.read.parquet(f"{sf_small}/events.parquet")
    folder = tempfile.mkdtemp(prefix="sf-stream-")
    days = sorted(r[0] for r in ev.select(F.to_date("ts")).distinct().collect())
    for i, day in enumerate(days):
        ev.where(F.to_date("ts") == F.lit(day)).coalesce(1).write.parquet(os.path.join(folder, f"d{i:03d}"))
        os.utime(os.path.join(folder, f"d{i:03d}"))
    schema = ev.schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)
    stream = stream.select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", "value")
    make = lambda s: st.stream_windows(s, "user_id", "ts", "event_id", "value", 16, 0.5, "60 days")
    got = st.run_to_end(make, stream, "ts", "test-st2").orderBy("user_id", "window_id").collect()
    from strideframe.operators import windows

    batch = windows.sliding_windows(ev, "user_id", "ts", "event_id", 16, 0.5).groupBy("user_id", "window_id").agg(
        F.avg("value").alias("mean_x"), F.count(F.lit(1)).alias("n")
    ).orderBy("user_id", "window_id").collect()
    assert len(got) == len(batch) > 0
    for a, b in zip(got, batch):
        assert (a["user_id"], a["window_id"], a["n"]) == (b["user_id"], b["window_id"], b["n"])
        assert a["mean_x"] == pytest.approx(b["mean_x"])


def _samples(n=800, users=2):
    from datetime import datetime, timedelta, timezone

    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    return [(i % users, start + timedelta(seconds=7 * (i // users)), i, float((i * 37) % 101)) for i in range(n)]


SAMPLE = "user_id long, ts timestamp, event_id long, value double"


def _write_files(spark, folder, parts):
    """One file for each part, each with a later modification time."""
    import time

    for i, rows in enumerate(parts):
        path = os.path.join(folder, f"p{i}")
        spark.createDataFrame(rows, SAMPLE).coalesce(1).write.parquet(path)
        for f in os.listdir(path):
            os.utime(os.path.join(path, f), (time.time() + i, time.time() + i))


def _event_windows(spark, parts, files, delay):
    folder = tempfile.mkdtemp(prefix="sf-stream-")
    _write_files(spark, folder, parts)
    stream = spark.readStream.schema(SAMPLE).option("maxFilesPerTrigger", files).option("recursiveFileLookup", "true").parquet(folder)
    out = st.run_to_end(lambda s: st.stream_windows(s, "user_id", "ts", "event_id", "value", 16, 0.5, delay), stream, "ts", "test-st2")
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("files", [1, 64])
def test_windows_do_not_depend_on_file_order(spark, files):
    """The later file first: all samples count, whatever a trigger takes."""
    rows = _samples()
    got = _event_windows(spark, [rows[400:], rows[:400]], files, "2 hours")
    want = []
    for u in range(2):
        x = [r[3] for r in rows if r[0] == u]
        for w in range((len(x) - 16) // 8 + 1):
            v = x[8 * w : 8 * w + 16]
            want.append((u, w, 16, round(sum(v) / 16, 9), min(v), max(v)))
    assert len(got) == 98 and [(*r[:3], round(r[3], 9), r[5], r[6]) for r in sorted(got)] == want


def test_samples_behind_the_watermark_are_counted(spark):
    rows = _samples()
    got = _event_windows(spark, [rows[400:], rows[:400]], 1, "10 seconds")
    late = [r for r in got if r[1] == st.LATE]
    assert sum(r[2] for r in late) == 400 and len(got) - len(late) == 48


def test_windows_of_odd_samples(spark):
    """Equal times go by the tie; no time is late; a series shorter than a window has none; NULL series are one series."""
    rows = _samples(64, 1)
    odd = [(None, t, i, v) for _, t, i, v in rows[:20]] + [(0, None, 999, 1.0), (5, rows[0][1], 7, 2.0)]
    same = [(9, rows[0][1], i, float(i)) for i in reversed(range(24))]
    got = _event_windows(spark, [rows + odd, same], 1, "1 hour")
    assert [r[:3] for r in got if r[0] == 9] == [(9, 0, 16), (9, 1, 16)]
    assert [r[5:7] for r in got if r[0] == 9] == [(0.0, 15.0), (8.0, 23.0)]
    assert [r[:3] for r in got if r[1] == st.LATE] == [(0, st.LATE, 1)]
    assert sum(r[0] is None for r in got) == 1 and not any(r[0] == 5 for r in got)


@pytest.mark.parametrize("fail_after_write", [False, True])
def test_totals_go_on_after_a_stop_in_any_batch(spark, monkeypatch, fail_after_write):
    """The chain is stopped in its second batch, before or after the batch's totals are written, and run again."""
    folder = tempfile.mkdtemp(prefix="sf-ab-")
    schema = "id long, variant string, y_pred int, y_true int"
    rows = [(i, "ab"[i % 3 == 0], i % 2, (i // 2) % 2) for i in range(300)]
    for k in range(3):
        spark.createDataFrame(rows[100 * k : 100 * k + 100], schema).coalesce(1).write.mode("append").parquet(f"{folder}/in/{k}")

    def joined():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{folder}/in")

    write = st._write_totals

    def stopping(batch, number, base):
        if number == 1 and not fail_after_write:
            raise RuntimeError("stopped")
        write(batch, number, base)
        if number == 1:
            raise RuntimeError("stopped")

    monkeypatch.setattr(st, "_write_totals", stopping)
    with pytest.raises(Exception, match="stopped"):
        st.run_totals(joined(), "test-ab", f"{folder}/ab", files_per_trigger=1)
    monkeypatch.setattr(st, "_write_totals", write)
    got = {r["variant"]: (r["n"], r["correct"]) for r in st.run_totals(joined(), "test-ab", f"{folder}/ab", files_per_trigger=1).collect()}
    want = {v: (sum(r[1] == v for r in rows), sum(r[1] == v and r[2] == r[3] for r in rows)) for v in "ab"}
    assert got == want
    # more input: the totals go on
    spark.createDataFrame([(900, "a", 1, 1)], schema).coalesce(1).write.parquet(f"{folder}/in/9")
    again = {r["variant"]: (r["n"], r["correct"]) for r in st.run_totals(joined(), "test-ab", f"{folder}/ab").collect()}
    assert again["a"] == (want["a"][0] + 1, want["a"][1] + 1) and again["b"] == want["b"]


def _classification_fixture(spark, n=500, d=20, k=4, seed=42):
    """Separable classes (as the reference's fixture: 500 x 20, 4 classes, first 400 train)."""
    import numpy as np

    rng = np.random.default_rng(seed)
    y = rng.integers(0, k, size=n)
    centres = rng.normal(scale=2.0, size=(k, d))
    x = centres[y] + rng.normal(size=(n, d))
    rows = [(i, float(y[i]), x[i].tolist(), "train" if i < 400 else "test") for i in range(n)]
    df = spark.createDataFrame(rows, "vec_id long, label double, v array<double>, split string")
    return learn.with_features(df, "v")


@pytest.mark.parametrize("kind", ["random_forest", "boosted_trees", "mlp"])
def test_models_beat_majority(spark, kind):
    data = _classification_fixture(spark).cache()
    est = {
        "random_forest": lambda: learn.random_forest(learn.ModelConfig(n_estimators=30)),
        "boosted_trees": lambda: learn.boosted_trees(learn.ModelConfig(n_estimators=5, max_depth=3)),
        "mlp": lambda: learn.mlp(20, 4, hidden=(16,), max_iter=100),
    }[kind]()
    model = est.fit(data.where("split = 'train'"))
    acc = learn.accuracy(model, data.where("split = 'test'"))
    majority = data.groupBy("label").count().agg(F.max("count")).first()[0] / data.count()
    assert acc > majority + 0.2


def test_cross_validation_and_search(spark):
    from strideframe.operators import splits

    data = splits.kfold(_classification_fixture(spark), "vec_id", "label", 3, 42).cache()
    scores, mean, std = learn.cross_validate(learn.random_forest(learn.ModelConfig(n_estimators=10, max_depth=5)), data)
    assert len(scores) == 3 and mean == pytest.approx(sum(scores) / 3) and std >= 0
    found = learn.search("random_forest", learn.grid({"n_estimators": [5, 10], "max_depth": [2]}), data)
    results, best = found.results, found.best
    assert found.model.getNumTrees == best["params"]["n_estimators"]
    assert len(results) == 2 and best["cv_mean"] == max(r["cv_mean"] for r in results)
    assert len(learn.random_maps({"a": [1, 2, 3], "b": [1, 2]}, 4, 42)) == 4


def test_model_roundtrip_same_scores(spark, sf_small):
    data = models.labelled(spark, sf_small)
    model = learn.fit_pipeline(learn.random_forest(learn.ModelConfig(n_estimators=5, max_depth=4)), data)
    path = tempfile.mkdtemp(prefix="sf-model-")
    learn.save_model(model, path)
    a = learn.batch_predict(model, data, ["vec_id"]).orderBy("vec_id").collect()
    b = learn.batch_predict(learn.load_model(path), data, ["vec_id"]).orderBy("vec_id").collect()
    assert a == b


def test_prediction_rows_and_softmax(spark):
    df = spark.createDataFrame([(1, 2, [0.1, 0.2, 0.7]), (2, 9, [0.5, 0.25, 0.25])], "id long, pred int, prob array<double>")
    rows = {r["id"]: r for r in scoring.prediction_rows(df, "id", "pred", "prob").collect()}
    assert rows[1]["activity"] == "WALKING_DOWNSTAIRS" and rows[2]["activity"] == "UNKNOWN_9"
    assert rows[1]["probabilities"]["WALKING"] == 0.1
    z = spark.createDataFrame([([1.0, 3.0, 3.0],)], "z array<double>")
    r = z.select(scoring.softmax(F.col("z")).alias("p"), scoring.argmax(F.col("z")).alias("a")).first()
    assert sum(r["p"]) == pytest.approx(1.0) and r["a"] == 1


def test_pca_matches_numpy_up_to_sign(spark, sf_small):
    import numpy as np

    from strideframe.operators import correlate

    e = spark.read.parquet(f"{sf_small}/embeddings.parquet").select("vec_id", "embedding")
    proj, ratios = correlate.pca(e, "embedding", 2)
    got = {r["vec_id"]: (r["pc_0"], r["pc_1"]) for r in proj.collect()}
    rows = sorted((r["vec_id"], r["embedding"]) for r in e.collect())
    x = np.array([v for _, v in rows], dtype=np.float64)
    xc = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(xc, full_matrices=False)
    ref = xc @ vt[:2].T
    for i, (vid, _) in enumerate(rows):
        assert abs(got[vid][0]) == pytest.approx(abs(ref[i, 0]), abs=1e-6)
        assert abs(got[vid][1]) == pytest.approx(abs(ref[i, 1]), abs=1e-6)
    evr = (s**2 / (s**2).sum())[:2]
    assert ratios == pytest.approx(evr.tolist(), abs=1e-9)


def test_boosted_trees_train_at_their_full_size(spark, sf_small, monkeypatch):
    class Seen(Exception):
        pass

    def boosted(config, weight=None):
        raise Seen(config.n_estimators, config.max_depth, config.learning_rate, weight)

    monkeypatch.setattr(learn, "boosted_trees", boosted)
    with pytest.raises(Seen) as found:
        models.m2_boosted_trees(spark, sf_small)
    assert found.value.args == (10, 4, 0.1, "weight")
