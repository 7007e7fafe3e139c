"""PCA of wide vectors by a randomised range finder (C7 beyond what one process holds squared).

The covariance is never formed.  A few directions more than asked for
(``EXTRA``) are drawn with a fixed seed and multiplied by X^T X, which is one
pass over the rows for each power step: every task adds up its rows' part of the
product, and the parts are added as a tree, by blocks of features.  Between
passes the directions are made orthonormal.  A last pass reduces the rows'
coordinates to one small triangle by QR factorisations of tasks' rows and of
stacked triangles (a tall QR as a tree); its singular values and vectors give
variances and components.  What the driver holds is features x directions.

With as many directions as features the result is exact; else the power steps
shrink the error by the ratio of variances to the power ``2 * steps + 1``.  The
sign of a component makes its loading of greatest size positive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.operators import gramian

EXTRA = 62
STEPS = 2
SEED = 42
#: features of a product that travel as one value
BLOCK = 4096
ROWS = 1024


def _batches(batches: Iterator[pa.RecordBatch], mean: np.ndarray) -> Iterator[np.ndarray]:
    """Centred rows, ``ROWS`` at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            part = batch.column(0).slice(lo, ROWS)
            yield part.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, len(mean)) - mean


def _part() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def _tree(rows: DataFrame, schema: str, keys: list[str], merge, parts: int) -> DataFrame:
    """Merge the rows of equal keys, ``ADDED_TOGETHER`` at a time, until one is left."""
    while parts > 1:
        parts = -(-parts // gramian.ADDED_TOGETHER)
        rows = rows.withColumn("part", F.col("part") % parts).groupBy(*keys, "part").applyInArrow(merge, schema)
    return rows


def _times_gramian(vectors: DataFrame, parts: int, mean: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``X^T X basis`` of the centred rows."""
    width, directions = basis.shape
    shared = vectors.sparkSession.sparkContext.broadcast((mean, basis))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, q = shared.value
        total = np.zeros(q.shape)
        for x in _batches(batches, centre):
            total += x.T @ (x @ q)
        for p, lo in enumerate(range(0, width, BLOCK)):
            raw = np.ascontiguousarray(total[lo : lo + BLOCK]).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([0], pa.int32()), pa.array([_part()], pa.int64()), pa.array([raw], pa.binary())], names=["p", "q", "part", "product"])

    found = _tree(vectors.mapInArrow(run, gramian._PRODUCT), gramian._PRODUCT, ["p", "q"], gramian._add, parts)
    out = np.zeros((width, directions))
    for r in found.toLocalIterator():
        out[r["p"] * BLOCK : (r["p"] + 1) * BLOCK] = np.frombuffer(bytes(r["product"])).reshape(-1, directions)
    shared.unpersist()
    return out


def _triangle(vectors: DataFrame, parts: int, mean: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """R of the QR factorisation of the rows' coordinates ``X basis``."""
    directions = basis.shape[1]
    shared = vectors.sparkSession.sparkContext.broadcast((mean, basis))
    schema = "part long, r binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, q = shared.value
        r = np.zeros((0, directions))
        for x in _batches(batches, centre):
            r = np.linalg.qr(np.vstack([r, x @ q]), mode="r")
        yield pa.RecordBatch.from_arrays([pa.array([_part()], pa.int64()), pa.array([r.tobytes()], pa.binary())], names=["part", "r"])

    def merge(group: pa.Table) -> pa.Table:
        stacked = [np.frombuffer(x).reshape(-1, directions) for x in group.column("r").to_pylist()]
        r = np.linalg.qr(np.vstack(stacked), mode="r")
        return group.slice(0, 1).set_column(1, "r", pa.array([r.tobytes()], pa.binary()))

    found = _tree(vectors.mapInArrow(run, schema), schema, [], merge, parts).collect()
    return np.vstack([np.frombuffer(bytes(r["r"])).reshape(-1, directions) for r in found])


def randomised_pca(df: DataFrame, vector_col: str, k: int = 2, extra: int = EXTRA, steps: int = STEPS, seed: int = SEED):
    """``(projected frame with pc_0..pc_{k-1}, explained variance ratios, components as rows)`` of an array column without NULLs."""
    vectors = df.select(F.col(vector_col).cast("array<double>").alias("v"))
    found = vectors.agg(Summarizer.metrics("mean", "variance", "count").summary(array_to_vector("v")).alias("s")).first()["s"]
    mean, total, n = found["mean"].toArray(), float(found["variance"].toArray().sum()), found["count"]
    width = len(mean)
    if not 1 <= k <= width:
        raise ValueError(f"k must be from 1 to {width}")
    parts = vectors.rdd.getNumPartitions()
    basis = np.random.default_rng(seed).normal(size=(width, min(width, k + extra)))
    for _ in range(steps):
        basis = np.linalg.qr(_times_gramian(vectors, parts, mean, np.linalg.qr(basis)[0]))[0]
    r = _triangle(vectors, parts, mean, basis)
    _, size, turn = np.linalg.svd(r, full_matrices=False)
    components = (basis @ turn.T).T[:k]
    top = np.abs(components).argmax(axis=1)
    components = components * np.sign(components[np.arange(len(components)), top])[:, None]
    share = [float(s * s / max(n - 1, 1) / total) if total else 0.0 for s in size[:k]]
    shared = df.sparkSession.sparkContext.broadcast((mean, np.ascontiguousarray(components.T)))

    @F.pandas_udf("array<double>")
    def project(values: pd.Series) -> pd.Series:
        centre, axes = shared.value
        if not len(values):
            return pd.Series([], dtype=object)
        return pd.Series(list((np.vstack(values.to_numpy()).astype(float) - centre) @ axes))

    out = df.withColumn("_pa", project(F.col(vector_col).cast("array<double>")))
    return out.select(*[c for c in df.columns if c != vector_col], *[F.col("_pa")[i].alias(f"pc_{i}") for i in range(k)]), share, components
