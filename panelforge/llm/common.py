"""What several operators share: batch sizes, files in the shared folder, tables written once, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelforge.session import cut_lineage, scratch_path

#: Rows and bytes of one Arrow batch handed to Python: keeps a worker's memory bounded whatever the texts' lengths.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def tasks(spark: SparkSession) -> int:
    """The session's own sizing of a shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table once into the shared folder and read it back: it survives lost executors and cuts the lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(uri: str):
    """(pyarrow file system, path) of a folder every executor reaches: plain path, file:, hdfs:, s3:, gs: …"""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def write_whole(uri: str, parts: Iterable[bytes]) -> None:
    """Write under a name of its own, then move into place: a task that runs twice leaves one whole file."""
    system, path = file_system(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(own) as out:
        for x in parts:
            out.write(x)
    system.move(own, path)


def mapped(uri: str):
    """A file's bytes as a buffer: memory-mapped where the file system is local, else read by range into memory."""
    from pyarrow import fs

    system, path = file_system(uri)
    if isinstance(system, fs.LocalFileSystem):
        if not system.get_file_info(path).size:
            return pa.py_buffer(b"")
        with pa.memory_map(path) as source:
            return source.read_buffer()
    with system.open_input_file(path) as source:
        return source.read_buffer()


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that a link names; root is the smallest node it can reach.

    Nodes are of any ordered type. Each round offers every node the smallest root among its neighbours and then
    jumps to the root's own root, so the number of rounds grows with the logarithm of the longest path.
    A node that many share is no bottleneck: offers are pre-aggregated and the joins can be split.
    """
    pair = lambda x, y: links.select(F.col(x).alias("node"), F.col(y).alias("other"))
    both = cut_lineage(pair(a, b).unionByName(pair(b, a)).filter("node <> other").distinct())
    label = cut_lineage(both.groupBy("node").agg(F.least("node", F.min("other")).alias("root")))
    while True:
        roots = label.select(F.col("node").alias("other"), "root")
        offered = both.join(roots, "other").groupBy("node").agg(F.min("root").alias("_offer"))
        lower = label.join(offered, "node").select("node", F.col("root").alias("_old"), F.least("root", "_offer").alias("_low"))
        jump = label.select(F.col("node").alias("_low"), F.col("root").alias("_jump"))
        moved = lower.join(jump, "_low").select("node", "_old", F.least("_low", "_jump").alias("root"))
        moved = cut_lineage(moved)
        label = moved.select("node", "root")
        if moved.filter("root <> _old").isEmpty():
            return label


def as_texts(column) -> list[str]:
    """Texts of an Arrow column, null as the empty text."""
    return [x or "" for x in column.to_pylist()]


def text_or_empty(c: str | Column = "text") -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
