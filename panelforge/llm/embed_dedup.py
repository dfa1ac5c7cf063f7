"""Near-duplicate vectors by sorted projection passes.

In each pass vectors are ordered by the concatenated signs of random projections, so near ones often share a long
prefix, and every vector is compared with a bounded window of its neighbours in that order. Pairs that the cosine
confirms are united across passes. Within the groups found this way all pairs are then compared in blocks, so the
number of a vector's links does not depend on the window: however large a group of near copies, none is lost.

How many passes are enough depends on how vectors crowd: in a dense cone many more signs must agree before two meet in a
window. So it is measured: some vectors get a probe, an artificial partner exactly at the threshold that takes part in all
passes without uniting anything, and rounds of passes go on until nearly all probes have met their vector's group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from panelforge.llm.common import components, small_batches, stored, tasks
from panelforge.session import cut_lineage

BLOCK, NEIGHBOURS = 512, 128
BITS = 63
#: Members of one part when a group is compared with itself.
PART = 1024
#: A pair just at the threshold is missed by the first round's passes with this probability if vectors spread evenly.
MISS = 0.001
#: Vectors that get a probe, and the share of probes that must be found before rounds end. Probes only decide when to stop.
PROBES, FOUND = 4000, 0.998


def passes_for(vectors: int, threshold: float, miss: float = MISS) -> int:
    """Passes after which a pair at the threshold is missed with probability ``miss``.

    A pass brings two vectors into one window when the first log2(vectors / window) signs agree.
    """
    agree = 1 - math.acos(min(1.0, threshold)) / math.pi
    together = agree ** max(1.0, math.log2(max(vectors, 2) / (2 * NEIGHBOURS)))
    return max(4, math.ceil(math.log(miss) / math.log(max(1e-12, 1 - together))))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a @ b.T) / (np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :])


def signs(vectors: np.ndarray, passes: int, seed: int) -> np.ndarray:
    """One 63-bit number per vector and pass: the first projection's sign is its highest bit."""
    dim = vectors.shape[1]
    out = np.zeros((len(vectors), passes), np.int64)
    for p in range(passes):
        plane = np.random.default_rng([seed, dim, p]).standard_normal((dim, BITS))
        out[:, p] = (vectors @ plane > 0) @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))
    return out


def _ranked(distinct: DataFrame, passes: int, seed: int) -> DataFrame:
    """(node, dim, pass, block): blocks of consecutive vectors in the pass's order, each with the neighbours that follow it."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array(batch.column(1).to_pylist())
            for dim in np.unique(dims):
                rows = batch.filter(pa.array(dims == dim))
                keys = signs(matrix(rows.column(2), int(dim)), passes, seed)
                n = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n * passes, dim, np.int32)), pa.array(np.tile(np.arange(passes, dtype=np.int32), n)), pa.array(keys.ravel()), pa.array(np.repeat(rows.column(0).to_numpy(), passes))],
                    names=["dim", "pass", "key", "node"],
                )

    spark = distinct.sparkSession
    keys = stored(distinct.select("node", "dim", "embedding").mapInArrow(hashed, "dim int, pass int, key long, node long"), "projection-keys")
    order = ["dim", "pass", "key", "node"]
    ordered = keys.repartitionByRange(tasks(spark), *order).sortWithinPartitions(*order)
    # The id counts rows within a partition from partition << 33 on.
    placed = stored(ordered.withColumn("_id", F.monotonically_increasing_id()), "projection-order")
    placed = placed.select("node", "dim", "pass", F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_at"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = placed.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    rank = F.col("_base") + F.col("_at")
    block = F.floor(rank / BLOCK)
    halo = (rank % BLOCK < NEIGHBOURS) & (rank >= BLOCK)
    to = F.when(halo, F.array(block, block - 1)).otherwise(F.array(block))
    # Blocks are grouped by pass and dimension too, so a window ends where either does.
    return placed.join(bases, "_part").select("node", "dim", "pass", F.explode(to).alias("block"))


def _united(near: np.ndarray) -> np.ndarray:
    """Smallest position that each row of a symmetric relation reaches."""
    label = np.arange(len(near))
    near = near | np.eye(len(near), dtype=bool)
    while True:
        low = np.where(near, label[None, :], len(near)).min(axis=1)
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _groups(batches: Iterator[pa.RecordBatch], keys: int, fn) -> Iterator[pa.RecordBatch]:
    """Stream sorted rows group by group: ``fn(key, rows)`` gets the group's columns as one table."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns[:keys]), ((batch, i) for i in range(batch.num_rows)))

    for key, group in groupby(rows(), key=lambda r: r[:keys]):
        parts: dict[int, tuple] = {}
        for *_, (batch, i) in group:
            parts.setdefault(id(batch), (batch, []))[1].append(i)
        table = pa.Table.from_batches([b.slice(at[0], at[-1] - at[0] + 1) for b, at in parts.values()]).combine_chunks()
        if (found := fn(key, table)) is not None:
            yield found


def probes(distinct: DataFrame, threshold: float, count: int = PROBES) -> DataFrame:
    """(node, dim, embedding) of one probe for each of about ``count`` vectors, at the threshold in a random direction.

    The probe of node v is node −1 − v."""

    def partner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, vectors = [], []
            for node, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                v = np.array(v) / np.abs(v).max()  # keeps the squares of very small or large entries finite
                v /= np.linalg.norm(v)
                away = np.random.default_rng(node).standard_normal(len(v))
                away -= (away @ v) * v
                if (size := np.linalg.norm(away)) > 1e-9:
                    aim = min(1.0, threshold + 1e-9)
                    nodes.append(-1 - node)
                    vectors.append((aim * v + np.sqrt(1 - aim * aim) * away / size).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([len(v) for v in vectors], pa.int32()), pa.array(vectors, pa.list_(pa.float64()))], ["node", "dim", "embedding"])

    step = max(1, distinct.count() // count)
    chosen = distinct.filter(F.pmod(F.xxhash64("node"), F.lit(step)) == 0).select("node", "embedding")
    return chosen.mapInArrow(partner, "node long, dim int, embedding array<double>")


def window_links(distinct: DataFrame, threshold: float, passes: int, seed: int = 17) -> DataFrame:
    """(a, b) links between nodes that unite whatever some pass brings into one window at the threshold or above.

    A probe (negative node) unites nothing: it gets one link (probe, node) to every group of its window that it is near to.
    """

    def compare(key: tuple, table: pa.Table) -> pa.RecordBatch | None:
        dim = key[0]
        x = matrix(table.column("embedding").chunk(0), dim)
        node = table.column("node").to_numpy()
        near = cosine(x, x) >= threshold
        real, probe = np.flatnonzero(node >= 0), np.flatnonzero(node < 0)
        label = real[_united(near[np.ix_(real, real)])] if len(real) else real
        linked = label != real
        a, b = [node[real[linked]]], [node[label[linked]]]
        for p in probe:
            groups = np.unique(label[near[p, real]])
            a.append(np.full(len(groups), node[p]))
            b.append(node[groups])
        a, b = np.concatenate(a), np.concatenate(b)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"]) if len(a) else None

    places = _ranked(distinct, passes, seed)
    rows = places.join(distinct.select("node", "embedding"), "node").select("dim", "pass", "block", "node", "embedding")
    keys = ["dim", "pass", "block"]
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lambda b: _groups(b, 3, compare), "a long, b long").distinct()


def near_groups(distinct: DataFrame, threshold: float, passes: int | None = None) -> DataFrame:
    """(node, root) of every node with a link, after as many rounds of passes as the probes ask for."""
    per_round = passes or passes_for(distinct.count(), threshold)
    # Partners at a threshold of one would be copies, which are one node already.
    tried = stored(probes(distinct if threshold < 1 - 1e-6 else distinct.limit(0), threshold), "probes")
    total = tried.count()
    taking_part = distinct.select("node", "dim", "embedding").unionByName(tried)
    links, met, seed = None, None, 17
    while True:
        found = stored(window_links(taking_part, threshold, per_round, seed), "window-links")
        own, of_probe = found.filter("a >= 0"), found.filter("a < 0")
        links = own if links is None else links.unionByName(own).distinct()
        met = of_probe if met is None else met.unionByName(of_probe)
        roots = cut_lineage(components(links))
        # A vector without links is a group of its own.
        group = lambda c: F.coalesce(F.col(f"{c}.root"), F.col(f"_{c}"))
        hit = met.select((-1 - F.col("a")).alias("_v"), F.col("b").alias("_w")).distinct()
        same = hit.join(roots.alias("v"), F.col("_v") == F.col("v.node"), "left").join(roots.alias("w"), F.col("_w") == F.col("w.node"), "left").filter(group("v") == group("w"))
        if same.select("_v").distinct().count() >= FOUND * total:
            return roots
        seed += 1


def link_counts(members: DataFrame, threshold: float, part: int = PART) -> DataFrame:
    """(node, links): for members (root, node, dim, copies, embedding) the rows of other nodes at the threshold or above.

    A group is dealt into parts by hash and every pair of parts is compared by a group of its own, in matrix products.
    """
    sizes = members.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / part).cast("int").alias("parts"))
    dealt = members.join(sizes, "root").withColumn("p", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    meets = F.expr("transform(sequence(0, parts - 1), q -> struct(least(p, q) AS lo, greatest(p, q) AS hi))")
    met = dealt.withColumn("m", F.explode(meets)).select("dim", "root", "m.lo", "m.hi", "p", "node", "copies", "embedding")

    def count(key: tuple, table: pa.Table) -> pa.RecordBatch | None:
        dim, _, lo, hi = key
        side, node, copies = (table.column(c).to_numpy() for c in ("p", "node", "copies"))
        x = matrix(table.column("embedding").chunk(0), dim)
        left = side == lo
        if lo == hi:
            near = cosine(x, x) >= threshold
            np.fill_diagonal(near, False)
            links = near @ copies
        else:
            near = cosine(x[left], x[~left]) >= threshold
            links = np.zeros(len(node), np.int64)
            links[left], links[~left] = near @ copies[~left], near.T @ copies[left]
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(links.astype(np.int64))], names=["node", "links"])

    keys = ["dim", "root", "lo", "hi"]
    counted = met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lambda b: _groups(b, 4, count), "node long, links long")
    return counted.groupBy("node").agg(F.sum("links").alias("links"))


def near_vectors(df: DataFrame, threshold: float = 0.95, key: str = "vec_id", vector: str = "embedding", passes: int | None = None) -> DataFrame:
    """(key, n_links, component_id, kept) of every row.

    Rows whose vector is null, empty, all zero or holds a null or non-finite component link with nothing. Vectors of
    different length are never compared. Equal vectors are one node with a number of copies; each of their rows links
    to all others of them. Repeated keys stay separate rows; component_id is the smallest key reachable. An empty table
    gives an empty result.
    """
    small_batches(df.sparkSession)
    x = F.col(vector).cast("array<double>")
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    valid = F.coalesce(good, F.lit(False))
    rows = df.filter(valid).select(F.col(key), x.alias("embedding"))
    distinct = rows.groupBy("embedding").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("copies"))
    distinct = stored(distinct.withColumns({"node": F.monotonically_increasing_id(), "dim": F.size("embedding")}), "distinct-vectors")
    roots = near_groups(distinct, threshold, passes)
    members = distinct.join(roots, "node").select("root", "node", "dim", "copies", "embedding")
    counts = link_counts(members, threshold)
    first = distinct.select("node", "first").join(roots, "node").groupBy("root").agg(F.min("first").alias("component_id"))
    found = roots.join(first, "root").join(counts, "node", "left").select("node", "component_id", "links")
    of_vector = distinct.select("embedding", "node", "first", "copies").join(found, "node", "left").select(
        "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"), F.coalesce("component_id", "first").alias("component_id"),
    )
    linked = rows.join(of_vector, "embedding").select(key, "n_links", "component_id")
    alone = df.filter(~valid).select(key, F.lit(0).cast("long").alias("n_links"), F.col(key).alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
