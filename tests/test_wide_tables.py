"""The wide case: 561 named columns, loaded from text files, described, selected and scaled."""

import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from strideframe.operators import correlate, learn, stats
from strideframe.operators.preprocess import Preprocessor
from strideframe.sources import matrix

WIDTH = 561


def split_files(rng):
    folder = tempfile.mkdtemp(prefix="sf-wide-")
    y = rng.integers(1, 7, 120)
    x = rng.normal(size=(120, WIDTH))
    x[:, :5] += 2 * y[:, None]
    x[:, 300] = x[:, 200] + 1e-3 * x[:, 201]
    for name, rows in (("X", x), ("y", y[:, None]), ("subject", np.arange(120)[:, None] % 30)):
        with open(os.path.join(folder, f"{name}_train.txt"), "w") as f:
            f.writelines("  ".join(repr(v) for v in r.tolist()) + "\n" for r in rows)
        os.rename(os.path.join(folder, f"{name}_train.txt"), os.path.join(folder, f"{name}_train"))
    return folder, x, y


def test_561_named_columns(spark):
    folder, x, y = split_files(np.random.default_rng(0))
    names = [f"f{i:03d}" for i in range(WIDTH)]
    rows = matrix.load_split(spark, folder, "train")
    df = matrix.named_columns(rows, names, ["row_id", "activity_id"]).cache()
    assert df.count() == 120 and len(df.columns) == WIDTH + 2
    found = {r["feature"]: r for r in stats.describe(df, names).collect()}
    assert len(found) == WIDTH
    for i in (0, 200, 560):
        r, v = found[names[i]], x[:, i]
        assert np.allclose([r["mean"], r["std"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]], [v.mean(), v.std(ddof=1), v.min(), *np.quantile(v, [0.25, 0.5, 0.75]), v.max()])
    corr = correlate.correlation_matrix(df, cols=names)
    assert [(r["i"], r["j"]) for r in correlate.correlated_pairs(corr, 0.95).where("i >= 5").collect()] == [(200, 300)]
    pre = Preprocessor(n_select_features=5, selection="f_classif")
    out = pre.fit_transform(df, "row_id", "activity_id", names)
    assert pre.selected_features == names[:5]
    train = out.where("split = 'train'")
    mean, sd = train.agg(F.avg("f000"), F.stddev_pop("f000")).first()
    assert abs(mean) < 1e-9 and abs(sd - 1) < 1e-9


def test_models_from_outside_give_null_for_null(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [0.5, 0.5])], "i long, v array<double>")
    got = {r["i"]: r["prediction"] for r in learn.predict_outside(lambda: lambda x: x.sum(axis=1), df, "v").collect()}
    assert got == {1: 3.0, 2: None, 3: 1.0}
