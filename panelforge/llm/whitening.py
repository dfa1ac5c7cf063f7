"""Embedding whitening from the singular values of the centred rows.

Sums are exact integers. Every task reduces its centred rows block by block to one triangle by QR, triangles of several
tasks are stacked and reduced again until one is left, and the qd solver of ``bidiagonal`` takes the directions from it.
The covariance itself is never formed, so small directions keep their digits. The driver sees one triangle: its size is
the dimension's, whatever the number of rows.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from panelforge.llm.bidiagonal import decompose
from panelforge.llm.common import small_batches

SCALE, SHIFT = 64, 1_000_000
#: Partial results that one task merges into one.
FAN_IN = 16
#: Components whose variance is below this share of the largest are rounding noise: nothing can be scaled to one there.
NOISE = 1e-13
#: Rows handled at once.
ROWS = 4096

PARTIAL = "part int, state binary"
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Whitening:
    """What the fit found: rows, their exact sums, unit directions as columns, variances and the sum of all variances."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    variances: np.ndarray
    total: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _exact(x, self.n, self.sums) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions / np.sqrt(self.variances)


def usable(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """(vec_id, v) of the rows whose vector has finite entries only, and the dimension.

    The dimension is the commonest length (of equally common ones the greatest); vectors of another length are left out, as nothing
    says which entries they lack. No usable row gives dimension 0.
    """
    v = F.col("v")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.filter(v.isNotNull() & ~bad & (F.size(v) > 0))
    common = rows.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dimension = common["d"] if common else 0
    return rows.filter(F.size(v) == dimension), dimension


def integers(column: pa.Array, dimension: int) -> np.ndarray:
    """floor(64 c) + 1,000,000 of every entry."""
    flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(float))
    if len(flat) and np.abs(flat).max() >= 2.0**62:
        raise OverflowError("a vector entry is too large for 64-bit integers")
    return flat.astype(np.int64).reshape(-1, dimension) + SHIFT


def _exact(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n·x − S, exactly."""
    if len(x) and float(np.abs(x).max()) * n >= 2.0**62:
        raise OverflowError("row count times entry exceeds 64-bit integers")
    return n * x - sums


def _reduced(rows: DataFrame, first: Callable, merge: Callable[[list], object]) -> object | None:
    """One state from all rows: ``first`` makes a task's state from its Arrow batches (None: no rows), ``merge`` joins several.

    States of ``FAN_IN`` tasks meet in one task, level by level; the driver receives the last one.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (state := first(batches)) is not None:
            yield _partial(TaskContext.get().partitionId(), state)

    def group(_: tuple, table: pa.Table) -> pa.Table:
        parts = sorted(zip(table.column("part").to_pylist(), table.column("state").to_pylist()))
        return pa.Table.from_batches([_partial(parts[0][0], merge([pickle.loads(s) for _, s in parts]))])

    states = rows.mapInArrow(task, PARTIAL)
    step, width = 1, rows.rdd.getNumPartitions()
    while step < width:
        step *= FAN_IN
        states = states.groupBy(F.floor(F.col("part") / step).alias("_g")).applyInArrow(group, PARTIAL)
    last = states.collect()
    return pickle.loads(bytes(last[0]["state"])) if last else None


def _partial(part: int, state: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([pickle.dumps(state)], pa.binary())], ["part", "state"])


def _blocks(batches: Iterable[pa.RecordBatch], dimension: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield integers(batch.column("v").slice(at, ROWS), dimension)


def fit(rows: DataFrame, dimension: int, count: int = 32) -> Whitening | None:
    """Directions of the ``count`` largest variances over all ``rows`` (from ``usable``); None where there is no row.

    Equal vectors count once each. Where the rows vary in fewer directions, there are fewer components; rows that are
    all equal have none.
    """

    def sums(batches):
        n, total = 0, np.zeros(dimension, np.int64)
        for x in _blocks(batches, dimension):
            n, total = n + len(x), total + x.sum(axis=0)
        return (n, total) if n else None

    found = _reduced(rows, sums, lambda parts: (sum(n for n, _ in parts), np.sum([s for _, s in parts], axis=0)))
    if found is None:
        return None
    n, total = found

    def triangle(batches):
        r = None
        for x in _blocks(batches, dimension):
            block = _exact(x, n, total) / n
            r = np.linalg.qr(block if r is None else np.vstack([r, block]), mode="r")
        return r

    r = _reduced(rows, triangle, lambda parts: np.linalg.qr(np.vstack(parts), mode="r"))
    square = np.zeros((dimension, dimension))
    square[: len(r)] = r
    values, directions = decompose(square, min(count, dimension))
    variances = values / n
    kept = int((variances[:count] > NOISE * variances[0]).sum()) if variances[0] > 0 else 0
    return Whitening(n, total, directions[:, :kept], variances[:kept], math.fsum(variances))


def identity_error(rows: DataFrame, dimension: int, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over all rows, centred block by block."""

    def moments(batches):
        state = None
        for x in _blocks(batches, dimension):
            w = model.whitened(x)
            mean = w.mean(axis=0)
            own = (len(w), mean, (w - mean).T @ (w - mean))
            state = own if state is None else _joined([state, own])
        return state

    n, _, spread = _reduced(rows, moments, _joined)
    return float(np.abs(spread / n - np.eye(len(spread))).max(initial=0.0))


def _joined(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Counts, means and centred squares of several sets as those of their union."""
    n, mean, spread = parts[0]
    for m, other, square in parts[1:]:
        apart, total = other - mean, n + m
        spread = spread + square + np.outer(apart, apart) * (n * m / total)
        mean, n = mean + apart * (m / total), total
    return n, mean, spread


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", count: int = 32) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): one row per usable vector and component.

    Left out are vectors that are null or empty, hold a null or non-finite entry, or have another length than most.
    Rows with a null or repeated id are rows like others; equal vectors get equal values; a table without usable rows, or whose
    rows are all equal, gives no rows; other columns are not read. ``deviation`` and the sums are exact; where they would
    leave 64 bits an OverflowError says so. Three passes of sums, triangles and the check come before the rows.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows, dimension = usable(vectors, key, vector)
    model = fit(rows, dimension, count) if dimension else None
    if model is None or not len(model.variances):
        return spark.createDataFrame([], OUT)
    error = identity_error(rows, dimension, model)
    k = len(model.variances)
    explained = model.variances / model.total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("vec_id").to_pylist()
            for at, x in zip(range(0, batch.num_rows, ROWS), _blocks([batch], dimension)):
                apart, m = _exact(x, model.n, model.sums), len(x)
                if float((apart.astype(float) ** 2).sum(axis=1).max()) >= 2.0**62:
                    raise OverflowError("a deviation exceeds 64-bit integers")
                deviation = (apart * apart).sum(axis=1)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": pa.array([v for v in keys[at : at + m] for _ in range(k)], pa.int64()),
                    "component": np.tile(np.arange(1, k + 1, dtype=np.int32), m), "n": np.full(m * k, model.n),
                    "deviation": np.repeat(deviation, k), "whitened": model.whitened(x).ravel(),
                    "explained": np.tile(explained, m), "identity_error": np.full(m * k, error),
                })

    return rows.mapInArrow(run, OUT)
