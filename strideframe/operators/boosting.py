"""Multi-class gradient-boosted trees with a softmax objective (M2).

Features are cut into quantile bins once.  A round adds one tree for each class,
all grown level by level together: one job a level sums first and second
derivatives of the loss by (class, node, feature, bin) inside each task, adds
the tasks' sums up as a tree, and finds each node's best split where its sums
are.  Only splits and leaf values (bounded by the tree budget)
come to the driver.  The rows are cached with their margins; those of the last
rounds are computed as they are needed, and every ``CHECKPOINT_ROUNDS`` rounds
the rows are checkpointed with them.  That bounds both this work and the lineage
that a lost executor has to run again.

Gain, leaf value and the bound on a child's second derivatives are the usual
second-order ones (``REGULARISATION`` is the L2 term).  Missing values lie in
the lowest bin.  Row samples are drawn by a hash of the row's number.
"""

from __future__ import annotations

import json
import random
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.session import checkpoint_dir

BINS = 64
REGULARISATION = 1.0
#: features whose sums travel as one vector
FEATURE_BLOCK = 512
#: bytes of rows that one task handles at most, and at least while cores are idle
TASK_BYTES = 64 << 20
LEAST_BYTES = 1 << 20
CHECKPOINT_ROUNDS = 8
#: sums of so many tasks are added in one step, then those sums, until one is left
ADDED_TOGETHER = 64
MAX_DEPTH = 12
#: cut points that the model holds at most (features x bins)
MAX_CUTS = 16_000_000

_STATE = "row long, label int, weight double, bins binary, margins binary"


def _matrix(col: pa.Array, kind: str, width: int) -> np.ndarray:
    """A binary column of equal lengths as the rows of a matrix."""
    return np.frombuffer(b"".join(col.to_pylist()), kind).reshape(-1, width)


def _leaves(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The place of each row in one tree (heap order; a negative feature marks a leaf)."""
    at = np.zeros(len(bins), np.int64)
    rows = np.arange(len(bins))
    while True:
        f = feature[at]
        inner = f >= 0
        if not inner.any():
            return at
        right = bins[rows, np.maximum(f, 0)] > cut[at]
        at = np.where(inner, 2 * at + 1 + right, at)


def number_of_task() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


def spread(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Rows of ``size`` bytes over as many tasks as they fill, on all cores if each still gets ``LEAST_BYTES``, and that number."""
    cores = min(-(-size // LEAST_BYTES), rows.sparkSession.sparkContext.defaultParallelism)
    parts, now = max(-(-size // TASK_BYTES), cores), rows.rdd.getNumPartitions()
    if parts < now:
        return rows.coalesce(parts), parts
    return (rows.repartition(cores), cores) if now < cores else (rows, now)


def _softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _binned(values: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin numbers: how many cut points are below each value; missing values are in bin 0."""
    out = np.empty(values.shape, np.uint8)
    for f, at in enumerate(cuts):
        x = values[:, f]
        out[:, f] = np.where(np.isnan(x), 0, np.searchsorted(at, x, "left"))
    return out


def quantile_cuts(rows: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """The cut points of each feature of the arrays ``x``: its quantiles, each once."""
    if width * bins > MAX_CUTS:
        raise ValueError(f"{width} features x {bins} bins exceed {MAX_CUTS} cut points")
    shares = [i / bins for i in range(1, bins)]
    long = rows.select(F.posexplode("x").alias("f", "v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    found = long.groupBy("f").agg(F.percentile_approx("v", shares, 20 * bins).alias("at")).collect()
    cuts = [np.zeros(0)] * width
    for r in found:
        cuts[r["f"]] = np.unique(np.array(r["at"], float))
    return cuts


def binned_rows(rows: DataFrame, cuts: list[np.ndarray], classes: int) -> DataFrame:
    """Numbered rows with the bins of their features and margins of 0."""
    width = len(cuts)
    zero = np.zeros(classes).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = np.full((b.num_rows, width), np.nan)
            for i, x in enumerate(b.column("x").to_pylist()):
                values[i, : len(x)] = [np.nan if v is None else v for v in x]
            bins = [r.tobytes() for r in _binned(values, cuts)]
            cols = [b.column("row"), b.column("label"), b.column("weight"), pa.array(bins, pa.binary()), pa.array([zero] * b.num_rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["row", "label", "weight", "bins", "margins"])

    return rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(run, _STATE)


@dataclass
class Round:
    """The trees of one round in heap order, one row for each class."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, classes: int, depth: int) -> Round:
        nodes = 2 ** (depth + 1) - 1
        return cls(np.full((classes, nodes), -1, np.int32), np.zeros((classes, nodes), np.uint8), np.zeros((classes, nodes)))

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return np.column_stack([v[_leaves(bins, f, c)] for f, c, v in zip(self.feature, self.cut, self.value, strict=True)])


def _margins(batch: pa.RecordBatch, pending: list[Round], classes: int, width: int) -> np.ndarray:
    """The margins of the rows of a batch after the rounds that their column does not hold yet."""
    total = _matrix(batch.column("margins"), "<f8", classes)
    bins = _matrix(batch.column("bins"), "u1", width)
    for trees in pending:
        total = total + trees.margins(bins)
    return total


@dataclass
class BoostedModel:
    """A fitted booster; ``transform`` adds ``rawPrediction``, ``probability`` (vectors) and ``prediction``."""

    cuts: list[np.ndarray]
    rounds: list[Round]
    classes: int
    gains: np.ndarray
    features_col: str = "features"
    stages: list = field(default_factory=list)

    @property
    def importances(self) -> list[float]:
        """Share of each feature in the gain of all splits."""
        total = self.gains.sum()
        return [float(g / total) if total else 0.0 for g in self.gains]

    def margins(self, values: Column) -> Column:
        """Margins of an array of features, one for each class."""
        cuts, rounds, classes = self.cuts, self.rounds, self.classes

        @F.pandas_udf("array<double>")
        def score(features: pd.Series) -> pd.Series:
            if not len(features):
                return pd.Series([], dtype=object)
            bins = _binned(np.vstack(features.to_numpy()).astype(float), cuts)
            total = np.zeros((len(bins), classes))
            for trees in rounds:
                total += trees.margins(bins)
            return pd.Series(list(total))

        return score(values)

    def transform(self, df: DataFrame) -> DataFrame:
        values = F.col(self.features_col)
        if not df.schema[self.features_col].dataType.typeName().startswith("array"):
            values = vector_to_array(values)
        top = F.array_max("_margins")
        e = F.transform("_margins", lambda m: F.exp(m - top))
        total = F.aggregate(e, F.lit(0.0), lambda a, b: a + b)
        best = (F.array_position("_margins", top) - 1).cast("double")
        scored = df.drop("rawPrediction", "probability", "prediction").withColumn("_margins", self.margins(values))
        return (
            scored.withColumn("rawPrediction", array_to_vector("_margins"))
            .withColumn("probability", array_to_vector(F.transform(e, lambda x: x / total)))
            .withColumn("prediction", best)
            .drop("_margins")
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the model as one row of text."""
        text = {
            "cuts": [c.tolist() for c in self.cuts],
            "rounds": [[r.feature.tolist(), r.cut.tolist(), r.value.tolist()] for r in self.rounds],
            "classes": self.classes,
            "gains": self.gains.tolist(),
            "features_col": self.features_col,
        }
        spark.createDataFrame([(json.dumps(text),)], "model string").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        m = json.loads(spark.read.parquet(path).first()["model"])
        rounds = [Round(np.array(f, np.int32), np.array(c, np.uint8), np.array(v)) for f, c, v in m["rounds"]]
        return cls([np.array(c) for c in m["cuts"]], rounds, m["classes"], np.array(m["gains"]), m["features_col"])


@dataclass
class Booster:
    """M2: settings of a fit.  ``max_features`` is the share (or rule) of features that a tree may use."""

    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.1
    subsample: float = 1.0
    max_features: str | float | None = None
    min_child_weight: float = 1.0
    seed: int = 42
    bins: int = BINS
    label_col: str = "label"
    weight_col: str | None = None
    features_col: str = "features"

    def fit(self, df: DataFrame) -> BoostedModel:
        if not 1 <= self.max_depth <= MAX_DEPTH:
            raise ValueError(f"max_depth must be from 1 to {MAX_DEPTH}")
        vectors = F.col(self.features_col)
        if not df.schema[self.features_col].dataType.typeName().startswith("array"):
            vectors = vector_to_array(vectors)
        weight = F.col(self.weight_col).cast("double") if self.weight_col else F.lit(1.0)
        rows = df.select(F.col(self.label_col).cast("int").alias("label"), weight.alias("weight"), vectors.cast("array<double>").alias("x"))
        rows = rows.where(F.col("label").isNotNull() & F.col("x").isNotNull())
        size = rows.agg(F.count(F.lit(1)).alias("n"), F.max("label").alias("top"), F.max(F.size("x")).alias("width")).first()
        if not size["n"]:
            raise ValueError("no labelled rows to learn from")
        classes, width = size["top"] + 1, size["width"]
        cuts = quantile_cuts(rows, width, self.bins)
        rows, parts = spread(rows, size["n"] * (width + 8 * classes + 24))
        state = binned_rows(rows, cuts, classes).persist(StorageLevel.MEMORY_AND_DISK)
        model = BoostedModel(cuts, [], classes, np.zeros(width), self.features_col)
        checkpoint_dir(df.sparkSession)
        pending: list[Round] = []  # rounds that the rows' margins do not hold yet
        for number in range(self.n_estimators):
            trees = self._grow(state, parts, number, model, pending)
            model.rounds.append(trees)
            pending.append(trees)
            if len(pending) == CHECKPOINT_ROUNDS and number + 1 < self.n_estimators:
                before, state, pending = state, self._advance(state, pending, classes, width).checkpoint(), []
                before.unpersist()
        state.unpersist()
        return model

    def _advance(self, state: DataFrame, pending: list[Round], classes: int, width: int) -> DataFrame:
        """Add the leaf values of some rounds to the rows' margins."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                margins = _margins(b, pending, classes, width)
                cols = [b.column(c) for c in ("row", "label", "weight", "bins")]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([m.tobytes() for m in margins], pa.binary())], names=["row", "label", "weight", "bins", "margins"])

        return state.mapInArrow(run, _STATE)

    def _allowed(self, number: int, classes: int, width: int) -> np.ndarray:
        """Which features each tree of a round may use."""
        share = {None: 1.0, "all": 1.0, "sqrt": width**-0.5, "log2": np.log2(max(width, 2)) / width}.get(self.max_features, self.max_features)
        most = max(1, min(width, round(float(share) * width)))
        out = np.zeros((classes, width), bool)
        for k in range(classes):
            out[k, random.Random(f"{self.seed}:{number}:{k}").sample(range(width), most)] = True
        return out

    def _grow(self, state: DataFrame, parts: int, number: int, model: BoostedModel, pending: list[Round]) -> Round:
        classes, width = model.classes, len(model.cuts)
        trees = Round.empty(classes, self.max_depth)
        allowed = self._allowed(number, classes, width)
        open_nodes = [[0] for _ in range(classes)]
        for depth in range(self.max_depth + 1):
            # leaf values of the last level come from their parents' sums
            found = self._level(state, parts, number, trees, open_nodes, allowed, model, pending) if depth < self.max_depth else []
            best: dict[tuple[int, int], tuple] = {}
            for r in found:
                key = (r["cls"], r["node"])
                if key not in best or (r["gain"], -r["feature"]) > (best[key]["gain"], -best[key]["feature"]):
                    best[key] = r
            after: list[list[int]] = [[] for _ in range(classes)]
            for (k, node), r in best.items():
                trees.value[k, node] = self.learning_rate * r["value"]
                if r["gain"] > 0:
                    trees.feature[k, node], trees.cut[k, node] = r["feature"], r["cut"]
                    trees.value[k, 2 * node + 1], trees.value[k, 2 * node + 2] = self.learning_rate * r["left"], self.learning_rate * r["right"]
                    model.gains[r["feature"]] += r["gain"]
                    after[k] += [2 * node + 1, 2 * node + 2]
            open_nodes = after
            if not any(after):
                break
        return trees

    def _level(self, state: DataFrame, parts: int, number: int, trees: Round, open_nodes: list, allowed: np.ndarray, model: BoostedModel, pending: list) -> list:
        """The best split of each open node: one row for each (class, node, block of features)."""
        classes, width, bins = model.classes, len(model.cuts), self.bins
        subsample, seed, least = self.subsample, self.seed + 7919 * number, self.min_child_weight
        blocks = range(0, width, FEATURE_BLOCK)

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = [np.zeros((len(nodes), width * bins, 2)) for nodes in open_nodes]
            place = [np.full(trees.feature.shape[1], -1) for _ in open_nodes]
            for at, nodes in zip(place, open_nodes, strict=True):
                at[nodes] = np.arange(len(nodes))
            for b in batches:
                own = _matrix(b.column("bins"), "u1", width)
                p = _softmax(_margins(b, pending, classes, width))
                weight = b.column("weight").to_numpy()
                if subsample < 1:
                    h = b.column("row").to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
                    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                    weight = weight * ((h >> np.uint64(11)) / 2.0**53 < subsample)
                label = b.column("label").to_numpy()
                columns = np.ascontiguousarray(own.T).astype(np.int64)
                for k in range(classes):
                    node = place[k][_leaves(own, trees.feature[k], trees.cut[k])]
                    rows = np.flatnonzero((node >= 0) & (weight > 0))
                    if not len(rows):
                        continue
                    q = p[rows, k]
                    g = weight[rows] * (q - (label[rows] == k))
                    h2 = weight[rows] * np.maximum(2 * q * (1 - q), 1e-16)
                    inner = total[k].reshape(len(open_nodes[k]), width, bins, 2)
                    first, size = node[rows] * bins, len(open_nodes[k]) * bins
                    for f in range(width):
                        at = first + columns[f][rows]
                        inner[:, f, :, 0] += np.bincount(at, g, size).reshape(-1, bins)
                        inner[:, f, :, 1] += np.bincount(at, h2, size).reshape(-1, bins)
            for k, nodes in enumerate(open_nodes):
                for i, node in enumerate(nodes):
                    for block in blocks:
                        found = total[k][i, block * bins : (block + FEATURE_BLOCK) * bins].ravel()
                        key = [pa.array([x], pa.int32()) for x in (k, node, block, number_of_task())]
                        yield pa.RecordBatch.from_arrays([*key, pa.array([found.tobytes()], pa.binary())], names=["cls", "node", "block", "part", "sums"])

        def add(group: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x, "<f8") for x in group.column("sums").to_pylist())
            return group.slice(0, 1).set_column(4, "sums", pa.array([total.tobytes()], pa.binary()))

        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = []
            for b in batches:
                for k, node, block, flat in zip(*[b.column(c).to_pylist() for c in ("cls", "node", "block", "sums")], strict=True):
                    gh = np.frombuffer(flat, "<f8").reshape(-1, bins, 2)
                    total = gh[0].sum(axis=0)
                    left = gh.cumsum(axis=1)[:, :-1]
                    right = total - left
                    score = lambda s: s[..., 0] ** 2 / (s[..., 1] + REGULARISATION)
                    gain = (score(left) + score(right) - score(total)) / 2
                    gain[(left[..., 1] < least) | (right[..., 1] < least)] = 0
                    gain[~allowed[k][block : block + len(gh)]] = 0
                    f, cut = np.unravel_index(int(gain.argmax()), gain.shape)
                    value = lambda s: float(-s[0] / (s[1] + REGULARISATION))
                    out.append((k, node, block + int(f), int(cut), float(gain[f, cut]), value(total), value(left[f, cut]), value(right[f, cut])))
            if out:
                cols = zip(*out, strict=True)
                kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), *[pa.float64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["cls", "node", "feature", "cut", "gain", "value", "left", "right"])

        best = "cls int, node int, feature int, cut int, gain double, value double, left double, right double"
        if parts == 1:
            return state.mapInArrow(lambda batches: split(sums(batches)), best).collect()
        kind = "cls int, node int, block int, part int, sums binary"
        added = state.mapInArrow(sums, kind)
        while parts > 1:
            parts = -(-parts // ADDED_TOGETHER)
            added = added.withColumn("part", F.col("part") % parts).groupBy("cls", "node", "block", "part").applyInArrow(add, kind)
        return added.mapInArrow(split, best).collect()
