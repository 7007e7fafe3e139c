"""Correlation of wide matrices by blocks (C1 beyond what one process holds).

Rows are centred and cut into blocks of features; a batch of rows becomes one
small matrix for each block.  Every pair of feature blocks (the upper triangle)
meets the matrices of both its sides, a bounded number of row batches at a time,
and gives a partial product; partial products of a pair are added up as a tree.
No process holds more than a few blocks, and the correlations stay distributed,
as rows ``i, j, r``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = 512
ROWS = 1024
#: row batches that one product takes, and partial products added in one step
BATCHES = 8
ADDED_TOGETHER = 32

_PRODUCT = "p int, q int, part long, product binary"


def _side(group: pa.Table, side: str) -> dict[int, np.ndarray]:
    picked = group.filter(pc.equal(group.column("side"), side))
    rows = zip(picked.column("batch").to_pylist(), picked.column("rows").to_pylist(), picked.column("values").to_pylist(), strict=True)
    return {b: np.frombuffer(raw, "<f8").reshape(n, -1) for b, n, raw in rows}


def _multiply(group: pa.Table) -> pa.Table:
    """The partial product of one pair of feature blocks over some row batches."""
    left, right = _side(group, "p"), _side(group, "q")
    total = sum(left[b].T @ right[b] for b in left)
    return group.select(["p", "q", "part"]).slice(0, 1).append_column("product", pa.array([total.tobytes()], pa.binary()))


def _add(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, "<f8") for x in group.column("product").to_pylist())
    return group.select(["p", "q", "part"]).slice(0, 1).append_column("product", pa.array([total.tobytes()], pa.binary()))


def _matrices(df: DataFrame, vector: str, mean: np.ndarray, features: int, rows: int) -> DataFrame:
    """``batch, block, rows, values``: the centred values of a batch of rows in a block of features."""
    width = len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                part = batch.column(0).slice(lo, rows)
                values = part.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width) - mean
                blocks = [np.ascontiguousarray(values[:, f : f + features]).tobytes() for f in range(0, width, features)]
                for block, raw in enumerate(blocks):
                    cols = [pa.array([number], pa.int64()), pa.array([block], pa.int32()), pa.array([len(values)], pa.int32()), pa.array([raw], pa.binary())]
                    yield pa.RecordBatch.from_arrays(cols, names=["batch", "block", "rows", "values"])
                number += 1

    return df.select(F.col(vector).cast("array<double>").alias("v")).mapInArrow(run, "batch long, block int, rows int, values binary")


def blocked_correlation(df: DataFrame, vector: str, features: int = FEATURES, rows: int = ROWS) -> DataFrame:
    """``i, j, r`` of all pairs of features of an array column without NULLs; a constant feature gives NaN, the diagonal 1."""
    found = df.agg(Summarizer.metrics("mean", "count").summary(array_to_vector(F.col(vector).cast("array<double>"))).alias("s")).first()["s"]
    mean, n = found["mean"].toArray(), found["count"]
    width = len(mean)
    blocks = -(-width // features)
    parts = -(-n // (rows * BATCHES))
    matrices = _matrices(df, vector, mean, features, rows)
    side = lambda p, q, name: F.struct(p.cast("int").alias("p"), q.cast("int").alias("q"), F.lit(name).alias("side"))
    own = F.col("block")
    as_left = F.transform(F.sequence(own, F.lit(blocks - 1)), lambda q: side(own, q, "p"))
    as_right = F.transform(F.sequence(F.lit(0), own), lambda p: side(p, own, "q"))
    sent = matrices.select("batch", "rows", "values", F.inline(F.concat(as_left, as_right)))
    # batches are dealt by hash: about BATCHES of them to a part
    dealt = sent.withColumn("part", F.pmod(F.xxhash64("batch"), F.lit(parts)))
    kinds = "p int, q int, part long, product binary"
    products = dealt.groupBy("p", "q", "part").applyInArrow(_multiply, kinds)
    while parts > 1:
        parts = -(-parts // ADDED_TOGETHER)
        products = products.withColumn("part", F.col("part") % parts).groupBy("p", "q", "part").applyInArrow(_add, _PRODUCT)
    # a feature's own sum of squares is on the diagonal of its block
    def diagonal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, raw in zip(b.column("p").to_pylist(), b.column("product").to_pylist(), strict=True):
                m = np.frombuffer(raw, "<f8").reshape(min(features, width - p * features), -1)
                yield pa.RecordBatch.from_arrays([pa.array(p * features + np.arange(len(m), dtype=np.int32), pa.int32()), pa.array(np.diag(m).copy())], names=["i", "square"])

    squares = products.filter("p = q").mapInArrow(diagonal, "i int, square double").toArrow()  # one number a feature, as the means
    norm = np.zeros(width)
    norm[squares.column("i").to_numpy()] = np.sqrt(squares.column("square").to_numpy())

    def correlations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, q, raw in zip(*[b.column(c).to_pylist() for c in ("p", "q", "product")], strict=True):
                i, j = (np.arange(k * features, min(width, (k + 1) * features)) for k in (p, q))
                with np.errstate(divide="ignore", invalid="ignore"):
                    r = np.frombuffer(raw, "<f8").reshape(len(i), len(j)) / np.outer(norm[i], norm[j])
                r = np.clip(r, -1, 1)
                if p == q:
                    r[np.arange(len(i)), np.arange(len(i))] = 1.0
                for one, other, values in ((i, j, r), (j, i, r.T))[: 1 if p == q else 2]:
                    for lo in range(0, len(one), 64):
                        rows_ = values[lo : lo + 64]
                        cols = [np.repeat(one[lo : lo + 64], len(other)), np.tile(other, len(rows_))]
                        yield pa.RecordBatch.from_arrays([*[pa.array(c.astype(np.int32)) for c in cols], pa.array(np.ascontiguousarray(rows_).ravel())], names=["i", "j", "r"])

    return products.mapInArrow(correlations, "i int, j int, r double")
