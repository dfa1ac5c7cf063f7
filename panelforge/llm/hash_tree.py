"""Sharding by a hierarchical weighted hash tree: region, rack and shard are drawn one below the other.

At each level every child draws ln(u) / weight, u a hash of the document's key and the child's name, and the largest draw
wins: a child is chosen in proportion to its weight (the sum of its shards'), and only its own draw depends on that weight.
So a changed weight moves rows only into or out of the subtrees above it; all other rows keep their shard. A shard added
as a branch of its own takes rows only into itself.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window, functions as F

from panelforge.llm.common import stored, tasks
from panelforge.session import scratch_path


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


@dataclass(frozen=True)
class Tree:
    leaves: tuple[Leaf, ...]

    def __post_init__(self):
        if not self.leaves or len({x.shard for x in self.leaves}) != len(self.leaves) or any(not x.weight > 0 for x in self.leaves):
            raise ValueError("a tree needs shards of different numbers and positive weights")

    def children(self, *path: int) -> list[tuple[int, float]]:
        """(name, weight) of the children of the root, of a region or of a rack."""
        sums: dict[int, float] = {}
        for x in self.leaves:
            names = (x.region, x.rack, x.shard)
            if names[: len(path)] == path:
                sums[names[len(path)]] = sums.get(names[len(path)], 0.0) + x.weight
        return sorted(sums.items())

    def with_weight(self, shard: int, weight: float) -> Tree:
        return Tree(tuple(replace(x, weight=weight) if x.shard == shard else x for x in self.leaves))

    def grown(self, weight: float = 1.0) -> Tree:
        """One more shard, in a region of its own."""
        region, shard = max(x.region for x in self.leaves) + 1, max(x.shard for x in self.leaves) + 1
        return Tree((*self.leaves, Leaf(region, 0, shard, weight)))


def even_tree(regions: int = 4, racks: int = 2, per_rack: int = 2) -> Tree:
    """Shards 0, 1, 2 … of one weight, rack by rack."""
    return Tree(tuple(
        Leaf(g, r, (g * racks + r) * per_rack + s) for g in range(regions) for r in range(racks) for s in range(per_rack)
    ))


def _nodes_sql(tree: Tree) -> str:
    """Map literal: a node's path to its children (their paths, names and weights)."""
    paths = sorted({(), *((x.region,) for x in tree.leaves), *((x.region, x.rack) for x in tree.leaves)})
    child = lambda path, name, weight: f"named_struct('path', '{'.'.join(map(str, (*path, name)))}', 'name', {name}, 'weight', {weight!r}D)"
    children = lambda path: ", ".join(child(path, name, float(weight)) for name, weight in tree.children(*path))
    return "map(" + ", ".join(f"'{'.'.join(map(str, path))}', array({children(path)})" for path in paths) + ")"


def descend(rows: DataFrame, key: str, tree: Tree, into: str) -> DataFrame:
    """Adds column ``into``: the shard of every row, decided by its key and the tree alone; rows with a null key share one shard.

    A child's u is uniform in (0, 1): 52 bits of the md5 of the key and the child's path, the same in any engine. Of equal
    draws the greater name wins. The tree is a literal of the plan: as long as there are shards, whatever the data.
    """
    text, nodes = f"coalesce(cast(`{key}` AS string), '')", _nodes_sql(tree)
    u = f"(cast(conv(substring(md5(cast(concat({text}, '/', c.path) AS binary)), 1, 13), 16, 10) AS double) + 0.5D) / {float(1 << 52)!r}D"
    won = lambda at: f"array_max(transform(element_at({nodes}, {at}), c -> named_struct('draw', ln({u}) / c.weight, 'name', c.name, 'path', c.path)))"
    node = f"_{into}_node"
    for at in ("''", f"{node}.path", f"{node}.path"):
        rows = rows.withColumn(node, F.expr(won(at)))
    return rows.withColumn(into, F.col(f"{node}.name")).drop(node)


def write_shards(docs: DataFrame, tree: Tree, folder: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write (doc_id, text) as Parquet under ``folder/shard=…`` and return the manifest (shard, part, rows, base).

    ``docs`` must be a table or another plan that gives the same rows in the same order when a task runs again.
    Rows are ordered by shard, key and text and shuffled once by ranges of that order, so a shard is written by several
    tasks; rows that are wholly equal are told apart by their place in the input, so a group of copies of any size is
    split as well. ``base`` counts the shard's rows in earlier parts: with a row's place in its part it gives gapless slots.
    Null keys share one shard and come first in it; null texts stay null and come before other texts of their key.
    Other columns of ``docs`` are not written.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    rows = descend(rows, "doc_id", tree, "shard").withColumns({
        "_crc": F.crc32(F.col("text").cast("binary")), "_size": F.octet_length("text"), "_row": F.monotonically_increasing_id(),
    })
    order = ["shard", "doc_id", "_crc", "_size", "_row"]
    ranged = rows.repartitionByRange(tasks(spark), *order).sortWithinPartitions(*order)
    # Row numbers of a task's own output: the part in the upper bits, the place in it in the lower 33.
    numbered = ranged.withColumn("_at", F.monotonically_increasing_id()).select(
        "doc_id", "text", "shard", F.shiftright("_at", 33).cast("int").alias("part"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("place")
    )
    numbered.write.partitionBy("shard").option("compression", "zstd").parquet(folder)
    parts = _files(spark, folder).groupBy("shard", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("first"))
    # A shard's window holds one row per part: as long as the shuffle is wide, whatever the data.
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("base", F.coalesce(F.sum("rows").over(before), F.lit(0)))


def _files(spark, folder: str) -> DataFrame:
    return spark.read.schema("doc_id long, text string, part int, place long, shard int").parquet(folder)


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, text, shard, slot) from the files: slots of a shard run from 0 without a gap."""
    rows = _files(manifest.sparkSession, folder)
    starts = manifest.select("shard", "part", (F.col("base") - F.col("first")).alias("_shift"))
    placed = rows.join(starts, ["shard", "part"])
    return placed.select("doc_id", "text", "shard", (F.col("place") + F.col("_shift")).alias("slot"))


def shards(docs: DataFrame, tree: Tree, grown: Tree | None = None, folder: str | None = None) -> DataFrame:
    """Write the shards (into a fresh folder of the shared one if unset), read them back and measure every row.

    (doc_id, size, text_crc32, law, shard, slot, grown_shard): the law is ``key``, as nothing but the key and the tree decides.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "shards")
    manifest = stored(write_shards(docs, tree, folder), "shard-manifest")
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = read_shards(manifest, folder).select(
        "doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"), "shard", "slot",
    )
    return descend(rows, "doc_id", grown or tree.grown(), "grown_shard")
