import itertools
import math

import pytest
from pyspark.sql import functions as F

from strideframe.operators import evaluate as ev
from strideframe.operators import experiments as ex


def _scored(spark, pairs):
    return spark.createDataFrame([(i, t, p) for i, (t, p) in enumerate(pairs)], "id long, y_true int, y_pred int")


def test_confusion_matrix_has_zero_cells(spark):
    s = _scored(spark, [(0, 0), (0, 1), (1, 1), (2, 1)])
    cm = {(r["y_true"], r["y_pred"]): r["count"] for r in ev.confusion_matrix(s).collect()}
    assert len(cm) == 9 and cm[(2, 2)] == 0 and cm[(0, 1)] == 1


def test_per_class_zero_division_and_averages(spark):
    s = _scored(spark, [(0, 0), (0, 1), (1, 1), (2, 1)])
    pc = {r["label"]: r for r in ev.per_class(s).collect()}
    assert pc[2]["precision"] == 0.0 and pc[2]["f1"] == 0.0
    assert pc[1]["precision"] == pytest.approx(1 / 3)
    av = ev.averages(ev.per_class(s)).first()
    assert av["recall_macro"] == pytest.approx((0.5 + 1 + 0) / 3)
    rep = {r["label"]: r for r in ev.report(s).collect()}
    assert rep["accuracy"]["f1"] == pytest.approx(0.5) and rep["accuracy"]["support"] == 4


def _brute_auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y]
    neg = [s for s, y in zip(scores, labels) if not y]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_auc_matches_brute_force_with_ties(spark):
    scores = [0.1, 0.4, 0.35, 0.8, 0.4, 0.4, 0.9, 0.05, 0.6, 0.6]
    labels = [0, 1, 0, 1, 0, 1, 1, 0, 0, 1]
    df = spark.createDataFrame([(i, 1, y, s) for i, (s, y) in enumerate(zip(scores, labels))], "id long, cls int, y_true int, p double")
    got = ev.roc_auc(df, binary=True).first()["auc"]
    assert got == pytest.approx(_brute_auc(scores, labels))
    curve = ev.roc_curve(df).collect()
    assert any(r["threshold"] is None and r["tpr"] == 0.0 for r in curve)
    assert max(r["tpr"] for r in curve) == 1.0


@pytest.mark.parametrize("per_range", [None, 5])
def test_roc_corners_keep_the_area_and_drop_flat_points(spark, monkeypatch, per_range):
    import random

    from strideframe.functions import cuts

    if per_range:
        monkeypatch.setattr(cuts, "ROWS_PER_RANGE", per_range)
    rng = random.Random(8)
    rows = [(c, int(rng.random() < 0.4) if c else 1 - int(i < 30), round(i / 60, 4) if c == 2 else rng.randrange(25) / 25) for c in range(3) for i in range(60)]
    df = spark.createDataFrame([(c, c if y else -1, p) for c, y, p in rows], "cls int, y_true int, p double")
    whole, corners = (
        {c: sorted(((r["fpr"], r["tpr"], r["threshold"] is not None) for r in ev.roc_curve(df, corners=k).collect() if r["cls"] == c)) for c in range(3)} for k in (False, True)
    )
    area = lambda points: sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:], strict=False))
    for c in range(3):
        assert set(corners[c]) <= set(whole[c]) and abs(area(corners[c]) - area(whole[c])) < 1e-12
        counts = {}
        for k, y, p in rows:
            if k == c:
                counts.setdefault(p, [0, 0])[1 - y] += 1
        steps = [tuple(counts[p]) for p in sorted(counts, reverse=True)]
        kept = [i for i in range(len(steps)) if i in (0, len(steps) - 1) or steps[i] != steps[i + 1]]
        assert len(corners[c]) == len(kept) + 1
    assert sum(map(len, corners.values())) < sum(map(len, whole.values()))


def test_chi_square_yates_and_p_value(spark):
    m = spark.createDataFrame([("control", 10, 8), ("treatment", 10, 4)], "variant string, n long, correct long")
    r = ex.ab_result(m, "control").first()
    assert r["chi2"] == pytest.approx(1.875)
    assert r["significant"] is False
    assert r["relative_improvement"] == pytest.approx((0.4 - 0.8) / 0.8)
    p = m.sparkSession.createDataFrame([(1.875,)], "c double").select(ex.chi2_p_value(F.col("c"))).first()[0]
    assert p == pytest.approx(math.erfc(math.sqrt(1.875 / 2)))


def test_chi_square_degenerate(spark):
    m = spark.createDataFrame([("control", 10, 10), ("treatment", 10, 10)], "variant string, n long, correct long")
    assert ex.ab_result(m, "control").first()["chi2"] == 0.0


def test_sample_size_known_value(spark):
    za, zb = ex.z_values(0.05, 0.80)
    df = spark.range(1).select(ex.sample_size(F.lit(0.90), F.lit(0.02), F.lit(za), F.lit(zb)).alias("n"))
    assert df.first()["n"] == 4007


def test_best_per_metric_first_wins_ties(spark):
    t = spark.createDataFrame([("m1", 0, 0.9, 0.5), ("m2", 1, 0.9, 0.7)], "model string, model_order int, acc double, f1 double")
    best = {r["metric"]: r["model"] for r in ev.best_per_metric(t, "model", "model_order", ["acc", "f1"]).collect()}
    assert best == {"acc": "m1", "f1": "m2"}
