"""A random forest over a few numbers and many one-hot slots whose work grows with the rows, not with rows times slots.

Trees grow level by level. Every task walks its rows through the trees so far and adds up, per open node and possible split, the
weight and target of the rows on one side: the rows under a threshold of a number, or those that have a slot. A row adds to the
slots it has and to no other; the other side of a split is what is left of its node. Spark sums these cells over all tasks and picks the best
of each node; the driver holds the trees only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import SparseVector
from pyspark.sql import Column, DataFrame, functions as F

from panelforge.session import cut_lineage

CELLS = "node int, feature int, cut int, w double, s double"
# A gain below this share of the node's own sum of squares is rounding.
ROUNDING = 1e-12


def _parts(features: str, numbers: int) -> tuple[Column, Column]:
    """The leading numbers of a vector as an array, and the positions of the slots set after them; the vector is never made dense."""
    v = F.unwrap_udt(F.col(features))
    values = v["values"]
    at = F.when(v["type"] == 0, v["indices"]).otherwise(F.transform(values, lambda _, i: i))
    entry = lambda i: F.coalesce(F.get(values, (F.array_position(at, i) - 1).cast("int")), F.lit(0.0))
    return F.array(*[entry(F.lit(i)) for i in range(numbers)]).cast("array<double>"), F.filter(at, lambda i: (i >= numbers) & (entry(i) != 0))


def _cuts(seen: list[float], bins: int) -> np.ndarray:
    """Cuts between the bins of a number with these quantiles, or the middles between its values if these are few."""
    values = np.unique(seen)
    return (values[1:] + values[:-1]) / 2 if len(values) <= bins else np.unique([seen[round((len(seen) - 1) * i / bins)] for i in range(1, bins)])


def _binned(x: pa.ListArray, thresholds: list[np.ndarray]) -> np.ndarray:
    """Bins by number and row."""
    values = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(thresholds))
    return np.array([np.searchsorted(t, values[:, j], "left") for j, t in enumerate(thresholds)], np.uint8).reshape(len(thresholds), len(x))


def _padded(lists: pa.ListArray) -> np.ndarray:
    """Lists as the columns of a matrix, filled up with -1."""
    n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.full((len(n), max(1, int(n.max(initial=0)))), -1, np.int32)
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)] = lists.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(out.T)


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    """Binaries of one length as the columns of a matrix."""
    return np.ascontiguousarray(np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width).T)


def _down(node: np.ndarray, feature: np.ndarray, cut: np.ndarray, binned: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """One step down a tree (children of n: 2n and 2n + 1); rows in a leaf stay."""
    f, d = feature[node], len(binned)
    right = slots[0] == f
    for more in slots[1:]:
        right |= more == f
    if d:
        at = np.minimum(f, d - 1) * len(f)
        at += np.arange(len(f))
        right |= (f < d) & (binned.ravel()[at] > cut[node])
    return np.where(f < 0, node, 2 * node + right)


def _mixed(x: np.ndarray) -> np.ndarray:
    """SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draw_keys(nodes: int, seed: int) -> np.ndarray:
    """Random words per node: a turn and the rounds of its shuffle."""
    at = np.arange(7 * nodes, dtype=np.uint64).reshape(7, nodes) + np.uint64(seed) * np.uint64(0x100000000)
    return _mixed(at * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))


def drawn(keys: np.ndarray, node: np.ndarray, feature: np.ndarray, size: int, share: int) -> np.ndarray:
    """Whether a node may split on a feature: of all ``size`` features, every node draws exactly ``share``.

    A keyed shuffle of the feature numbers (swap-or-not), so no task needs a list of the features drawn.
    """
    turns = (keys % np.uint64(size)).astype(np.int64)
    x = feature + turns[0][node]
    x -= size * (x >= size)
    for key, turn in zip(keys[1:], turns[1:]):
        other = turn[node] - x
        other += size * (other < 0)
        swap = ((key[node] ^ np.maximum(x, other).astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(63)
        x = np.where(swap, other, x)
    return x < share


class SparseForestModel(Model):
    """Trees as arrays by node number (root 1, children of n: 2n and 2n + 1); a prediction is the mean of the trees' leaves."""

    def __init__(self, features: str, size: int, thresholds: list[np.ndarray], feature: np.ndarray, cut: np.ndarray, value: np.ndarray, gain: np.ndarray):
        super().__init__()
        self.features, self.numFeatures, self.thresholds = features, size, thresholds
        self.feature, self.cut, self.value, self.gain = feature, cut, value, gain

    @property
    def getNumTrees(self) -> int:
        return len(self.feature)

    @property
    def featureImportances(self) -> SparseVector:
        """Gains per feature, each tree's summed to one, then all."""
        total = self.gain.sum(1, keepdims=True)
        share = np.divide(self.gain, total, out=np.zeros_like(self.gain), where=total > 0)
        sums = np.bincount(self.feature[self.feature >= 0], share[self.feature >= 0], minlength=self.numFeatures)
        at = np.flatnonzero(sums)
        return SparseVector(self.numFeatures, at.tolist(), (sums[at] / sums.sum()).tolist() if len(at) else [])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        thresholds, feature, cut, value = self.thresholds, self.feature, self.cut, self.value
        deep = feature.shape[1].bit_length() - 2

        def score(x: pa.Array, slots: pa.Array) -> pa.Array:
            binned, set_ = _binned(x, thresholds), _padded(slots)
            total = np.zeros(len(x))
            for t in range(len(feature)):
                node = np.ones(len(x), np.int64)
                for _ in range(deep):
                    node = _down(node, feature[t], cut[t], binned, set_)
                total += value[t][node]
            return pa.array(total / len(feature))

        return dataset.withColumn("prediction", F.arrow_udf(score, "double")(*_parts(self.features, len(thresholds))))


class SparseForestRegressor(Estimator):
    """As Spark's random forest: bootstrapped trees, a third of the features drawn per node, splits by variance, up to ``bins`` bins
    a number - for vectors of ``numbers`` numbers followed by slots that are 0 or set."""

    def __init__(self, label: str, numbers: int, features: str = "features", trees: int = 160, leaf: int = 2, depth: int = 8, bins: int = 32, seed: int = 7):
        super().__init__()
        self.label, self.numbers, self.features = label, numbers, features
        self.trees, self.leaf, self.depth, self.bins, self.seed = trees, leaf, depth, bins, seed

    def _rows(self, rows: DataFrame, thresholds: list[np.ndarray], mean: float) -> DataFrame:
        """Binned rows with their weight in each tree's bootstrap sample. Rows with the same slots lie together, so that their cells
        meet in one task; a slot of many rows is spread over several."""
        trees, seed = self.trees, self.seed

        def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
            for b in batches:
                weights = np.minimum(rng.poisson(1.0, (len(b), trees)), 255).astype(np.uint8)
                columns = [[r.tobytes() for r in m] for m in (np.ascontiguousarray(_binned(b["x"], thresholds).T), weights)]
                yield pa.record_batch([pa.array(columns[0], pa.binary()), b["slots"], pa.array(b["y"].to_numpy(zero_copy_only=False) - mean), pa.array(columns[1], pa.binary())], names=["bins", "slots", "y", "bag"])

        parts = rows.sparkSession.sparkContext.defaultParallelism
        dealt = rows.withColumn("at", F.rand(seed)).repartitionByRange(parts, "slots", "at").sortWithinPartitions("slots", "at").drop("at")
        return cut_lineage(dealt.mapInArrow(bag, "bins binary, slots array<int>, y double, bag binary"))

    def _sums(self, rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Weight and target sum of every tree's root."""
        trees = self.trees

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w, s = np.zeros(trees), np.zeros(trees)
            for b in batches:
                bag = _bytes(b["bag"], trees)
                w += bag.sum(1, dtype=np.int64)
                s += bag @ b["y"].to_numpy(zero_copy_only=False)
            yield pa.record_batch([pa.array(np.arange(trees, dtype=np.int32)), pa.array(w), pa.array(s)], names=["tree", "w", "s"])

        found = rows.mapInArrow(sums, "tree int, w double, s double").groupBy("tree").agg(F.sum("w"), F.sum("s")).orderBy("tree").collect()
        return np.array([r[1] for r in found]), np.array([r[2] for r in found])

    def _cells(self, rows: DataFrame, level: int, open_: np.ndarray, feature: np.ndarray, cut: np.ndarray, size: int, n_bins: int) -> DataFrame:
        """One side of every possible split of the level's open nodes."""
        trees, d, seed, nodes, share = self.trees, self.numbers, self.seed, feature.shape[1], -(-size // 3)
        width = 1 << level

        def batch(t: int, node: np.ndarray, f: np.ndarray, c: np.ndarray, w: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
            columns = [pa.array((t * nodes + width + node).astype(np.int32)), pa.array(f.astype(np.int32)), pa.array(c.astype(np.int32)), pa.array(w, pa.float64()), pa.array(s, pa.float64())]
            return pa.record_batch(columns, names=["node", "feature", "cut", "w", "s"])

        def summed(key: np.ndarray, w: np.ndarray, s: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
            """Keys that occur, their weights and targets."""
            if most > 4 * len(key):
                found, key = np.unique(key, return_inverse=True)
                return found, np.bincount(key, w), np.bincount(key, s)
            w, s = np.bincount(key, w, most), np.bincount(key, s, most)
            found = np.flatnonzero(w)
            return found, w[found], s[found]

        def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys = draw_keys(trees * nodes, seed).reshape(7, trees, nodes)[:, :, width : 2 * width]
            bins = width * n_bins
            totals = np.zeros((2, trees, d * bins))
            number, at = (x.ravel() for x in np.indices((d, width)))
            asked = [drawn(keys[:, t], at, number, size, share).reshape(d, width) for t in range(trees)]
            for b in batches:
                y, bag = b["y"].to_numpy(zero_copy_only=False), _bytes(b["bag"], trees)
                binned, slots = _bytes(b["bins"], d), _padded(b["slots"])
                # The slots of this batch, with one that stands for none.
                codes, coded = np.unique(np.append(slots, -1), return_inverse=True)
                coded, out = coded[:-1].reshape(slots.shape), []
                for t in np.flatnonzero(open_.any(1)):
                    row = np.flatnonzero(bag[t])
                    node, own, set_ = np.ones(len(row), np.int64), binned[:, row], slots[:, row]
                    for _ in range(level):
                        node = _down(node, feature[t], cut[t], own, set_)
                    if level:
                        keep = np.flatnonzero(open_[t][node])
                        row, node, own = row[keep], node[keep], own[:, keep]
                    node -= width
                    w = bag[t][row].astype(np.float64)
                    s = w * y[row]
                    j, i = np.nonzero(asked[t][:, node])
                    key = j * bins + node[i] * n_bins + own[j, i]
                    totals[0, t] += np.bincount(key, w[i], d * bins)
                    totals[1, t] += np.bincount(key, s[i], d * bins)
                    key = (node * len(codes) + coded[:, row]).ravel()
                    found, w, s = summed(key, np.tile(w, len(slots)), np.tile(s, len(slots)), width * len(codes))
                    node, f = found // len(codes), codes[found % len(codes)]
                    keep = np.flatnonzero((f >= 0) & drawn(keys[:, t], node, f, size, share))
                    out.append(batch(t, node[keep], f[keep], np.full(len(keep), -1), w[keep], s[keep]))
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
            under = totals.reshape(2, trees, d, width, n_bins)
            for t in range(trees):
                w, s = under[:, t].cumsum(-1)
                j, node, c = np.nonzero(w[:, :, :-1])
                yield batch(t, node, j, c, w[j, node, c], s[j, node, c])

        return rows.mapInArrow(cells, CELLS)

    def _best(self, cells: DataFrame, total_w: np.ndarray, total_s: np.ndarray, open_: np.ndarray) -> list:
        """The split of most gain of every node that has one."""
        at = np.flatnonzero(open_)
        known = cells.sparkSession.createDataFrame(pa.table({"node": pa.array(at.astype(np.int32)), "W": total_w.ravel()[at], "S": total_s.ravel()[at]}))
        w, s, W, S = (F.col(c) for c in ("w", "s", "W_", "S_"))  # noqa: N806
        summed = cells.groupBy("node", "feature", "cut").agg(F.sum("w").alias("w"), F.sum("s").alias("s"))
        sides = summed.join(F.broadcast(known.toDF("node", "W_", "S_")), "node").filter((w >= self.leaf) & (W - w >= self.leaf))
        squares = s * s / w + (S - s) * (S - s) / (W - w)
        gained = sides.withColumn("gain", squares - S * S / W).filter(F.col("gain") > ROUNDING * squares)
        order = F.struct("gain", -F.col("feature"), -F.col("cut"))
        return gained.groupBy("node").agg(F.max_by(F.struct("feature", "cut", "w", "s", "gain"), order).alias("b")).select("node", "b.*").collect()

    def _fit(self, dataset: DataFrame) -> SparseForestModel:
        x, slots = _parts(self.features, self.numbers)
        v, y = F.unwrap_udt(F.col(self.features)), F.col("y")
        rows = dataset.select(x.alias("x"), slots.alias("slots"), F.col(self.label).cast("double").alias("y"), F.coalesce(v["size"], F.size(v["values"])).alias("size"))
        quantiles = [F.percentile_approx(F.col("x")[j], [i / 1000 for i in range(1001)], 10_000) for j in range(self.numbers)]
        n, bad, mean, size, *seen = rows.agg(F.count(F.lit(1)), F.count_if(y.isNull() | F.isnan(y)), F.avg(y), F.max("size"), *quantiles).first()
        if not n or bad:
            raise ValueError(f"{n} rows to fit, {bad} of them without a number as label")
        thresholds = [_cuts(q, self.bins) for q in seen]
        rows = self._rows(rows, thresholds, mean)
        n_bins = max([len(t) + 1 for t in thresholds], default=1)
        shape = (self.trees, 2 << self.depth)
        feature, cut = np.full(shape, -1, np.int32), np.zeros(shape, np.int32)
        w, s, gain, open_ = np.zeros(shape), np.zeros(shape), np.zeros(shape), np.zeros(shape, bool)
        w[:, 1], s[:, 1] = self._sums(rows)
        for level in range(self.depth):
            first = 1 << level
            open_[:] = False
            open_[:, first : 2 * first] = w[:, first : 2 * first] >= 2 * self.leaf
            if not open_.any():
                break
            best = self._best(self._cells(rows, level, open_, feature, cut, size, n_bins), w, s, open_)
            if not best:
                break
            at, f, c, side_w, side_s, more = (np.array(v) for v in zip(*best))
            t, node = at // shape[1], at % shape[1]
            feature[t, node], cut[t, node], gain[t, node] = f, c, more
            # A cell is what lies under a threshold (left), or what has a slot (right).
            side, other = 2 * node + (f >= self.numbers), 2 * node + (f < self.numbers)
            w[t, side], s[t, side] = side_w, side_s
            w[t, other], s[t, other] = w[t, node] - side_w, s[t, node] - side_s
        value = mean + np.divide(s, w, out=np.zeros(shape), where=w > 0)
        return SparseForestModel(self.features, size, thresholds, feature, cut, value, gain)
