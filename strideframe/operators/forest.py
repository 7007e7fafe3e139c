"""Forests of unlimited or great depth (M1).

Such a tree has about as many nodes as rows, and nearly all of them hold a few rows.
One table of sums for each node, which a fit level by level moves between tasks,
then weighs far more than the rows.  Here only nodes of more than ``NODE_ROWS``
rows are split from sums over all tasks, the nodes of all trees together in one
job a level.  The rows of a smaller node, with the trees' number as key, then meet in
one task, which grows the rest of that branch.

Trees are the usual ones: quantile bins, rows drawn with replacement (Poisson
numbers by a hash of the row's number and the tree's), a draw of features at
each node, weighted Gini impurity, class shares of the leaves averaged over the
trees.  The fitted trees, which hold a few bytes for each node, come to the driver.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strideframe.operators.boosting import ADDED_TOGETHER, _binned, _matrix, binned_rows, number_of_task, quantile_cuts, spread

BINS = 32
#: rows, as often as they were drawn, of a node whose branch one task grows
NODE_ROWS = 16_384
#: numbers in a table of sums
CELLS = 200_000
#: bytes of rows of small nodes that one task handles
BRANCH_BYTES = 4 << 20
#: gains below this share of a node's weight are rounding errors
LEAST_GAIN = 1e-9

_BRANCH = "tree int, node int, depth int, feature binary, cut binary, left binary, value binary, shares binary, gains binary"


def _walk(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, root: int = 0) -> np.ndarray:
    """The node that each row ends in (a negative feature marks a leaf; the right child follows the left one)."""
    at = np.full(len(bins), root, np.int64)
    rows = np.arange(len(bins)) if feature[root] >= 0 else np.zeros(0, np.int64)
    while len(rows):
        here = at[rows]
        here = left[here] + (bins[rows, feature[here]] > cut[here])
        at[rows] = here
        rows = rows[feature[here] >= 0]
    return at


def _drawn(row: np.ndarray, tree: int, seed: int, rate: float) -> np.ndarray:
    """How often a tree draws each row: Poisson numbers."""
    h = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 1_000_003 + tree) * 0xD6E8FEB86659FD93 % 2**64)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(by)
    u = ((h ^ (h >> np.uint64(31))) >> np.uint64(11)) / 2.0**53
    share = np.cumsum([math.exp(-rate) * rate**k / math.factorial(k) for k in range(40)])
    return np.searchsorted(share, u, "right")


def _best_cuts(sums: np.ndarray, n: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Of tables (.., bins, classes) and row numbers (.., bins): the best gain, its cut, the left and right sums and row numbers."""
    left, below = sums.cumsum(-2), n.cumsum(-1)
    whole, many = left[..., -1:, :], below[..., -1:]
    left, below = left[..., :-1, :], below[..., :-1]
    right, above = whole - left, many - below
    score = lambda x: (x * x).sum(-1) / np.maximum(x.sum(-1), 1e-300)
    gain = score(left) + score(right) - score(whole)
    gain[(below < least) | (above < least)] = 0
    cut = gain.argmax(-1)
    at = cut[..., None]
    pick = lambda x: np.take_along_axis(x, at, -1)[..., 0]
    sides = [np.take_along_axis(x, at[..., None], -2)[..., 0, :] for x in (left, right)]
    return pick(gain), cut, *sides, pick(below), pick(above)


def _choices(rng: np.random.Generator, nodes: int, width: int, most: int) -> np.ndarray:
    """``most`` different features for each node."""
    if most >= width:
        return np.tile(np.arange(width), (nodes, 1))
    return np.argpartition(rng.random((nodes, width)), most, axis=1)[:, :most]


def grow_branch(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, copies: np.ndarray, classes: int, levels: int, most: int, least: int, rng: np.random.Generator):
    """All nodes below one: ``feature, cut, left, sums`` by node, and the gain of each feature."""
    size, width = 2 * len(label) + 1, bins.shape[1]
    feature, cut, left = np.full(size, -1, np.int32), np.zeros(size, np.uint8), np.zeros(size, np.int32)
    sums, gains = np.zeros((size, classes)), np.zeros(width)
    ids, used = np.zeros(1, np.int64), 1
    rows, place = np.arange(len(label)), np.zeros(len(label), np.int64)
    for level in range(levels + 1):
        sums[ids] = np.bincount(place * classes + label[rows], weight[rows], len(ids) * classes).reshape(-1, classes)
        mixed = np.flatnonzero((sums[ids] > 0).sum(axis=1) > 1)
        if level == levels or not len(mixed):
            break
        new = np.full(len(ids), -1)
        new[mixed] = np.arange(len(mixed))
        ids, place = ids[mixed], new[place]
        rows, place = rows[place >= 0], place[place >= 0]
        order = np.argsort(place, kind="stable")
        rows, place = rows[order], place[order]
        chosen = _choices(rng, len(ids), width, most)
        best = LEAST_GAIN * sums[ids].sum(axis=1)
        split_by, split_at = np.full(len(ids), -1), np.zeros(len(ids), np.int64)
        step = max(1, CELLS // (BINS * classes))
        for a in range(0, len(ids), step):
            b = min(a + step, len(ids))
            i, j = np.searchsorted(place, [a, b])
            r, p = rows[i:j], place[i:j] - a
            for slot in range(chosen.shape[1]):
                f = chosen[a:b, slot]
                cell = p * BINS + bins[r, f[p]]
                table = np.bincount(cell * classes + label[r], weight[r], (b - a) * BINS * classes).reshape(b - a, BINS, classes)
                n = np.bincount(cell, copies[r], (b - a) * BINS).reshape(b - a, BINS)
                gain, at, *_ = _best_cuts(table, n, least)
                better = np.flatnonzero(gain > best[a:b])
                best[a + better], split_by[a + better], split_at[a + better] = gain[better], f[better], at[better]
        done = np.flatnonzero(split_by >= 0)
        if not len(done):
            break
        feature[ids[done]], cut[ids[done]] = split_by[done], split_at[done]
        left[ids[done]] = used + 2 * np.arange(len(done))
        np.add.at(gains, split_by[done], best[done])
        kept = split_by[place] >= 0
        rows, place = rows[kept], place[kept]
        right = bins[rows, split_by[place]] > split_at[place]
        child = np.zeros(len(ids), np.int64)
        child[done] = 2 * np.arange(len(done))
        place = child[place] + right
        ids = used + np.arange(2 * len(done))
        used += len(ids)
    return feature[:used], cut[:used], left[:used], sums[:used], gains


def _values(feature: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node the class of a pure leaf, or ``classes`` + its place among the class shares of the mixed ones."""
    classes = sums.shape[1]
    value = sums.argmax(axis=1).astype(np.int32)
    mixed = np.flatnonzero((feature < 0) & ((sums > 0).sum(axis=1) != 1))
    value[mixed] = classes + np.arange(len(mixed))
    total = sums[mixed].sum(axis=1, keepdims=True)
    return value, np.where(total > 0, sums[mixed] / np.where(total > 0, total, 1), 1 / classes)


@dataclass
class ForestModel:
    """A fitted forest; ``transform`` adds ``rawPrediction``, ``probability`` (vectors) and ``prediction``."""

    cuts: list[np.ndarray]
    classes: int
    roots: np.ndarray  # the first node of each tree
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    shares: np.ndarray  # of all classes first, each alone, then of the mixed leaves
    gains: np.ndarray
    features_col: str = "features"

    @property
    def importances(self) -> list[float]:
        """Mean over the trees of each feature's share in the gain of the splits."""
        total = self.gains.sum()
        return [float(g / total) if total else 0.0 for g in self.gains]

    def transform(self, df: DataFrame) -> DataFrame:
        values = F.col(self.features_col)
        if not df.schema[self.features_col].dataType.typeName().startswith("array"):
            values = vector_to_array(values)
        parts = (self.cuts, self.roots, self.feature, self.cut, self.left, self.value, self.shares)
        sent = df.sparkSession.sparkContext.broadcast(parts)

        @F.pandas_udf("array<double>")
        def score(features: pd.Series) -> pd.Series:
            if not len(features):
                return pd.Series([], dtype=object)
            cuts, roots, feature, cut, left, value, shares = sent.value
            bins = _binned(np.vstack(features.to_numpy()).astype(float), cuts)
            total = np.zeros((len(bins), shares.shape[1]))
            for root in roots.tolist():
                total += shares[value[_walk(bins, feature, cut, left, root)]]
            return pd.Series(list(total))

        top, trees = F.array_max("_votes"), float(len(self.roots))
        scored = df.drop("rawPrediction", "probability", "prediction").withColumn("_votes", score(values))
        return (
            scored.withColumn("rawPrediction", array_to_vector("_votes"))
            .withColumn("probability", array_to_vector(F.transform("_votes", lambda x: x / trees)))
            .withColumn("prediction", (F.array_position("_votes", top) - 1).cast("double"))
            .drop("_votes")
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the model as one row: settings as text, arrays as bytes."""
        text = json.dumps({"cuts": [c.tolist() for c in self.cuts], "classes": self.classes, "features_col": self.features_col})
        arrays = [np.ascontiguousarray(getattr(self, c), kind).tobytes() for c, kind in _SAVED.items()]
        schema = "model string, " + ", ".join(f"`{c}` binary" for c in _SAVED)
        spark.createDataFrame([(text, *arrays)], schema).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ForestModel:
        r = spark.read.parquet(path).first()
        m = json.loads(r["model"])
        arrays = {c: np.frombuffer(bytes(r[c]), kind) for c, kind in _SAVED.items()}
        arrays["shares"] = arrays["shares"].reshape(-1, m["classes"])
        return cls([np.array(c) for c in m["cuts"]], m["classes"], features_col=m["features_col"], **arrays)


_SAVED = {"roots": "<i8", "feature": "<i4", "cut": "u1", "left": "<i8", "value": "<i8", "shares": "<f8", "gains": "<f8"}


class _Tree:
    """The upper nodes of a tree while it grows; ``branches`` are the nodes that wait for their rows."""

    def __init__(self, branch: bool, classes: int):
        self.feature, self.cut, self.left, self.sums = [-1], [0], [0], [np.zeros(classes)]
        self.open = [] if branch else [0]
        self.branches = {0: 0} if branch else {}

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.feature, np.int32), np.array(self.cut, np.uint8), np.array(self.left, np.int64)


@dataclass
class Forest:
    """M1: settings of a fit."""

    n_estimators: int = 100
    max_depth: int = 30
    min_instances: int = 1
    max_features: str | float | None = "sqrt"
    subsample: float = 1.0
    seed: int = 42
    label_col: str = "label"
    weight_col: str | None = None
    features_col: str = "features"

    def _most(self, width: int) -> int:
        share = {None: 1.0, "all": 1.0, "sqrt": math.sqrt(width) / width, "log2": math.log2(max(width, 2)) / width}.get(self.max_features, self.max_features)
        return max(1, min(width, math.ceil(round(float(share) * width, 9))))

    def fit(self, df: DataFrame) -> ForestModel:
        vectors = F.col(self.features_col)
        if not df.schema[self.features_col].dataType.typeName().startswith("array"):
            vectors = vector_to_array(vectors)
        weight = F.col(self.weight_col).cast("double") if self.weight_col else F.lit(1.0)
        rows = df.select(F.col(self.label_col).cast("double").alias("label"), weight.alias("weight"), vectors.cast("array<double>").alias("x"))
        bad = F.col("label").isNull() | F.isnan("label") | (F.col("label") < 0) | (F.col("label") != F.floor("label"))
        bad = bad | F.col("weight").isNull() | ~(F.col("weight") >= 0) | F.col("x").isNull() | F.exists("x", lambda v: v.isNull() | F.isnan(v))
        size = rows.agg(
            F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad"), F.max("label").alias("top"), F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("width")
        ).first()
        if not size["n"]:
            raise ValueError("no labelled rows to learn from")
        if size["bad"] or size["least"] != size["width"]:
            raise ValueError("labels must be whole numbers from 0, weights not negative, vectors without missing values and of one length")
        classes, width = int(size["top"]) + 1, size["width"]
        cuts = quantile_cuts(rows, width, BINS)
        rows, parts = spread(rows.withColumn("label", F.col("label").cast("int")), size["n"] * (width + 24))
        state = binned_rows(rows, cuts, 0).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            trees = [_Tree(size["n"] * self.subsample <= NODE_ROWS, classes) for _ in range(self.n_estimators)]
            gains = np.zeros((self.n_estimators, width))
            for depth in range(self.max_depth):
                if not any(t.open for t in trees):
                    break
                self._level(state, parts, depth, trees, gains, classes, width)
            found = self._branches(state, trees, classes, width, size["n"])
        finally:
            state.unpersist()
        return self._joined(trees, found, gains, cuts, classes)

    def _level(self, state: DataFrame, parts: int, depth: int, trees: list[_Tree], gains: np.ndarray, classes: int, width: int) -> None:
        """Split the large nodes of all trees, as many in one job as their sums allow."""
        most = self._most(width)
        nodes = [(t, node) for t, tree in enumerate(trees) for node in tree.open]
        step = max(1, 80 * CELLS // (most * BINS * (classes + 1)))
        for tree in trees:
            tree.open = []
        for a in range(0, len(nodes), step):
            rng = np.random.default_rng([self.seed, depth, a])
            some = nodes[a : a + step]
            for r in self._splits(state, parts, trees, some, _choices(rng, len(some), width, most), classes):
                t, node = some[r["place"]]
                tree = trees[t]
                sides = [np.frombuffer(bytes(r[c]), "<f8") for c in ("left", "right")]
                tree.sums[node] = sides[0] + sides[1]
                if r["gain"] <= LEAST_GAIN * tree.sums[node].sum():
                    continue
                tree.feature[node], tree.cut[node], tree.left[node] = r["feature"], r["cut"], len(tree.feature)
                gains[t, r["feature"]] += r["gain"]
                for side, n in zip(sides, (r["below"], r["above"]), strict=True):
                    child = len(tree.feature)
                    tree.feature.append(-1)
                    tree.cut.append(0)
                    tree.left.append(0)
                    tree.sums.append(side)
                    if depth + 1 < self.max_depth and (side > 0).sum() > 1:
                        if n <= NODE_ROWS:
                            tree.branches[child] = depth + 1
                        else:
                            tree.open.append(child)

    def _splits(self, state: DataFrame, parts: int, trees: list[_Tree], some: list[tuple[int, int]], chosen: np.ndarray, classes: int) -> list:
        """The best split of each node, found where its sums are."""
        seed, rate, least, most = self.seed, self.subsample, self.min_instances, chosen.shape[1]
        tops = {t: trees[t].arrays() for t, _ in some}
        place = {t: np.full(len(tops[t][0]), -1) for t in tops}
        for i, (t, node) in enumerate(some):
            place[t][node] = i

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(some) * most * BINS, classes + 1))
            for b in batches:
                bins = np.frombuffer(b"".join(b.column("bins").to_pylist()), "u1").reshape(b.num_rows, -1)
                label, weight, row = (b.column(c).to_numpy() for c in ("label", "weight", "row"))
                for t, top in tops.items():
                    copies = _drawn(row, t, seed, rate)
                    at = place[t][_walk(bins, *top)]
                    rows = np.flatnonzero((at >= 0) & (copies > 0))
                    if not len(rows):
                        continue
                    at = at[rows]
                    # the nodes of one tree lie side by side
                    low, n = at.min(), at.max() - at.min() + 1
                    for slot in range(most):
                        cell = (at - low) * BINS + bins[rows, chosen[at, slot]]
                        by_class = np.bincount(cell * classes + label[rows], copies[rows] * weight[rows], n * BINS * classes).reshape(n, BINS, classes)
                        by_rows = np.bincount(cell, copies[rows], n * BINS).reshape(n, BINS)
                        view = total.reshape(len(some), most, BINS, classes + 1)[low : low + n, slot]
                        view[..., :classes] += by_class
                        view[..., classes] += by_rows
            for i, one in enumerate(total.reshape(len(some), -1)):
                if one.any():
                    key = [pa.array([x], pa.int32()) for x in (i, number_of_task())]
                    yield pa.RecordBatch.from_arrays([*key, pa.array([one.tobytes()], pa.binary())], names=["place", "part", "sums"])

        def add(group: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x, "<f8") for x in group.column("sums").to_pylist())
            return group.slice(0, 1).set_column(2, "sums", pa.array([total.tobytes()], pa.binary()))

        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i, flat in zip(b.column("place").to_pylist(), b.column("sums").to_pylist(), strict=True):
                    table = np.frombuffer(flat, "<f8").reshape(most, BINS, classes + 1)
                    gain, cut, left, right, below, above = _best_cuts(table[..., :classes], table[..., classes], least)
                    s = int(gain.argmax())
                    out = [i, int(chosen[i, s]), int(cut[s]), float(gain[s]), left[s].tobytes(), right[s].tobytes(), int(below[s]), int(above[s])]
                    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
                    names = ["place", "feature", "cut", "gain", "left", "right", "below", "above"]
                    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(out, kinds, strict=True)], names=names)

        kind = "place int, part int, sums binary"
        added = state.mapInArrow(sums, kind)
        while parts > 1:
            parts = -(-parts // ADDED_TOGETHER)
            added = added.withColumn("part", F.col("part") % parts).groupBy("place", "part").applyInArrow(add, kind)
        return added.mapInArrow(split, "place int, feature int, cut int, gain double, left binary, right binary, below long, above long").collect()

    def _branches(self, state: DataFrame, trees: list[_Tree], classes: int, width: int, n: int) -> dict:
        """Grow the branches below the small nodes, each where its rows meet."""
        seed, rate, least, most, deepest = self.seed, self.subsample, self.min_instances, self._most(width), self.max_depth
        tops = {t: tree.arrays() for t, tree in enumerate(trees) if tree.branches}
        depths = {t: np.full(len(top[0]), -1) for t, top in tops.items()}
        for t in tops:
            for node, depth in trees[t].branches.items():
                depths[t][node] = depth

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                bins = _matrix(b.column("bins"), "u1", width)
                row = b.column("row").to_numpy()
                for t, top in tops.items():
                    copies = _drawn(row, t, seed, rate)
                    node = _walk(bins, *top)
                    depth = depths[t][node]
                    kept = np.flatnonzero((depth >= 0) & (copies > 0))
                    if not len(kept):
                        continue
                    some = b.select(["label", "weight", "bins"]).take(pa.array(kept))
                    keys = [pa.array(x, pa.int32()) for x in (np.full(len(kept), t), node[kept], depth[kept], copies[kept])]
                    yield pa.RecordBatch.from_arrays([*keys, *some.columns], names=["tree", "node", "depth", "copies", "label", "weight", "bins"])

        def grow(group: pa.Table) -> pa.Table:
            t, node, depth = (group.column(c)[0].as_py() for c in ("tree", "node", "depth"))
            bins = np.frombuffer(b"".join(group.column("bins").to_pylist()), "u1").reshape(-1, width)
            label, copies, weight = (group.column(c).to_numpy() for c in ("label", "copies", "weight"))
            rng = np.random.default_rng([seed, t, node])
            feature, cut, left, sums, gains = grow_branch(bins, label, copies * weight, copies, classes, deepest - depth, most, least, rng)
            value, shares = _values(feature, sums)
            arrays = [feature, cut, left, value, shares, gains]
            cols = [*[pa.array([x], pa.int32()) for x in (t, node, depth)], *[pa.array([x.tobytes()], pa.binary()) for x in arrays]]
            return pa.Table.from_arrays(cols, names=[c.split()[0] for c in _BRANCH.split(", ")])

        if not tops:
            return {}
        kind = "tree int, node int, depth int, copies int, label int, weight double, bins binary"
        share = 1 - math.exp(-rate)
        parts = max(1, -(-int(n * self.n_estimators * share * (width + 40)) // BRANCH_BYTES))
        parts = min(parts, sum(len(t.branches) for t in trees))
        met = state.mapInArrow(meet, kind).repartition(parts, "tree", "node")
        return {(r["tree"], r["node"]): r for r in met.groupBy("tree", "node").applyInArrow(grow, _BRANCH).collect()}

    def _joined(self, trees: list[_Tree], found: dict, gains: np.ndarray, cuts: list[np.ndarray], classes: int) -> ForestModel:
        """One array of each kind for all trees; a branch takes the place of its node."""
        roots, arrays, shares = [], [], [np.eye(classes)]
        used, mixed = 0, classes
        for t, tree in enumerate(trees):
            roots.append(used)
            feature, cut, left = tree.arrays()
            value, own = _values(feature, np.array(tree.sums))
            value = np.where(value >= classes, value - classes + mixed, value)
            left = left + used
            shares.append(own)
            mixed += len(own)
            blocks = [[feature, cut, left, value]]
            after = used + len(feature)
            for node in tree.branches:
                r = found.get((t, node))
                if r is None:  # no row was drawn
                    continue
                b_feature, b_cut, b_left, b_value, b_shares, b_gains = (
                    np.frombuffer(bytes(r[c]), k) for c, k in zip(("feature", "cut", "left", "value", "shares", "gains"), ("<i4", "u1", "<i4", "<i4", "<f8", "<f8"), strict=True)
                )
                b_shares = b_shares.reshape(-1, classes)
                # the branch's first node is written over the node itself; the others follow
                b_left = b_left.astype(np.int64) + after - 1
                b_value = np.where(b_value >= classes, b_value - classes + mixed, b_value)
                feature[node], cut[node], left[node], value[node] = b_feature[0], b_cut[0], b_left[0], b_value[0]
                blocks.append([b_feature[1:], b_cut[1:], b_left[1:], b_value[1:]])
                after += len(b_feature) - 1
                shares.append(b_shares)
                mixed += len(b_shares)
                gains[t] += b_gains
            arrays += blocks
            used = after
        feature, cut, left, value = (np.concatenate(x) for x in zip(*arrays, strict=True))
        total = gains.sum(axis=1, keepdims=True)
        by_feature = np.where(total > 0, gains / np.where(total > 0, total, 1), 0).sum(axis=0)
        return ForestModel(cuts, classes, np.array(roots, np.int64), feature, cut, left, value.astype(np.int64), np.concatenate(shares), by_feature, self.features_col)
