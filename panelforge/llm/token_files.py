"""Token-id output: flat files of unsigned integers and 64-bit document offsets, read back through memory maps.

Part ``p`` of a set has ``p.ids`` (all ids of its documents, little-endian, 16 or 32 bits by vocabulary size),
``p.off`` (n + 1 unsigned 64-bit offsets into it, in ids) and ``p.docs`` (n signed 64-bit document ids). The manifest
table names every part with its counts and its base: the ids before it in the whole set, from prefix sums.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from panelforge.llm.common import as_texts, mapped, small_batches, stored, tasks, text_or_empty, write_whole
from panelforge.llm.tokens import encoder
from panelforge.session import scratch_path

#: Key of rows without one in ``.docs``: the file has no null.
NO_KEY = -(1 << 63)
MANIFEST = "part string, place int, documents long, tokens long, bytes_per_id int"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text, append ``end_id``, write the files in ascending key order, return the manifest with bases.

    Null texts are empty (the end id alone); rows with one key stay separate rows, ordered by a hash of the text; rows whose key is
    null come first and carry ``NO_KEY`` in ``.docs``, which no real key may be; an empty table gives an empty manifest.
    The texts are shuffled once, by ranges of key, text hash and place in the input, so a key or a row that repeats often is split; ``docs``
    must give its rows in the same order when a task runs again, as tables do. A part is encoded and written by one task,
    batch by batch. A task that runs again writes the same bytes to the same name.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(key).cast("long").alias("k"), text_or_empty(text).alias("t"))
    order = ["k", "_hash", "t", "_row"]
    tagged = rows.withColumns({"_hash": F.xxhash64("t"), "_row": F.monotonically_increasing_id()})
    # Texts whose hashes are equal by chance may be split between parts in either order; that is all that leaving the text out changes.
    ordered = tagged.repartitionByRange(tasks(spark), "k", "_hash", "_row").sortWithinPartitions(*order).select("k", "t")

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        name, enc = f"{folder}/part-{place:06d}", encoder(vocabulary)
        end, size = np.array([end_id], enc.dtype).tobytes(), enc.dtype.itemsize
        keys, counts = [], []

        def pieces() -> Iterator[bytes]:
            for batch in batches:
                keys.extend(map(_stored_key, batch.column(0).to_pylist()))
                for ids in enc.encode(as_texts(batch.column(1))):
                    counts.append(len(ids) // size + 1)
                    yield ids + end

        first = next(stream := pieces(), None)
        if first is None:
            return
        write_whole(f"{name}.ids", _chain(first, stream))
        offsets = np.zeros(len(counts) + 1, "<u8")
        np.cumsum(counts, out=offsets[1:])
        write_whole(f"{name}.off", [offsets.tobytes()])
        write_whole(f"{name}.docs", [np.array(keys, "<i8").tobytes()])
        yield pa.RecordBatch.from_pydict({"part": [name], "place": pa.array([place], pa.int32()), "documents": [len(counts)], "tokens": [int(offsets[-1])], "bytes_per_id": pa.array([size], pa.int32())})

    # One row per part: its window of all parts is as long as the shuffle is wide, whatever the data.
    parts = stored(ordered.mapInArrow(part, MANIFEST), "token-manifest")
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def _stored_key(k: int | None) -> int:
    if k == NO_KEY:
        raise ValueError(f"document id {NO_KEY} stands for rows without an id")
    return NO_KEY if k is None else k


def _real_keys(stored_keys: np.ndarray) -> pa.Array:
    return pa.array(stored_keys, pa.int64(), mask=stored_keys == NO_KEY)


def _chain(first: bytes, rest: Iterator[bytes]) -> Iterator[bytes]:
    yield first
    yield from rest


def read_token_files(manifest: DataFrame) -> DataFrame:
    """One row per document from the files alone: id, start in the whole set, number of ids, checksum of the ids."""
    rows = manifest.select("part", "documents", "bytes_per_id", "base").repartition(tasks(manifest.sparkSession))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, n, size, base in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(mapped(f"{part}.ids"), f"<u{size}")
                offsets = np.frombuffer(mapped(f"{part}.off"), "<u8").astype(np.int64)
                docs = np.frombuffer(mapped(f"{part}.docs"), "<i8")
                for lo in range(0, n, 10_000):
                    hi = min(n, lo + 10_000)
                    sums = [zlib.crc32(ids[offsets[i] : offsets[i + 1]].astype("<u4").tobytes()) for i in range(lo, hi)]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": _real_keys(docs[lo:hi]), "start": base + offsets[lo:hi], "n_tokens": np.diff(offsets[lo : hi + 1]),
                        "ids_crc32": pa.array(sums, pa.int64()),
                    })

    return rows.mapInArrow(read, READ)


def read_ids(manifest: DataFrame) -> DataFrame:
    """(doc_id, ids) of every document: the token arrays themselves, for a trainer that wants rows."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, n, size in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(mapped(f"{part}.ids"), f"<u{size}")
                offsets = np.frombuffer(mapped(f"{part}.off"), "<u8").astype(np.int64)
                docs = np.frombuffer(mapped(f"{part}.docs"), "<i8")
                for lo in range(0, n, 1000):
                    hi = min(n, lo + 1000)
                    yield pa.RecordBatch.from_pydict({"doc_id": _real_keys(docs[lo:hi]), "ids": pa.array([ids[offsets[i] : offsets[i + 1]].astype(np.int32) for i in range(lo, hi)], pa.list_(pa.int32()))})

    return manifest.select("part", "documents", "bytes_per_id").mapInArrow(read, "doc_id long, ids array<int>")


def token_files(docs: DataFrame, vocabulary: str, end_id: int = 1, folder: str | None = None) -> DataFrame:
    """Write the set into ``folder`` (a fresh one of the shared folder if unset) and read it back."""
    return read_token_files(write_token_files(docs, folder or scratch_path(docs.sparkSession, "token-files"), vocabulary, end_id))
