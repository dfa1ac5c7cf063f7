"""Distinct-word tables: texts as positions in a block's word list, words once per block, answers joined back by position.

A block is a stretch of documents of one task with at most ``WORDS`` distinct words. Its texts become rows of word
numbers in a file of the shared folder; its words go to a table, in buckets by hash. What is to be known of a word is
computed once per distinct word of the corpus, returned to the blocks, and gathered there by position. So what is
shuffled is words per block, not words per text, and a word that fills half of all texts is one row per block.
"""

from __future__ import annotations

import secrets
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from panelforge.llm.common import as_texts, mapped, small_batches, stored, tasks, text_or_empty, write_whole
from panelforge.session import scratch_path

#: Distinct words and word positions of one block: bounds a task's memory.
WORDS, POSITIONS = 1 << 19, 1 << 23
#: Word lists of a block are cut into buckets by hash: at least so many, and some for each task of a shuffle. A bucket's
#: distinct words meet in one task.
BUCKETS, BUCKETS_PER_TASK = 1024, 4


class Numbers(dict):
    """Words numbered from 0 in the order of their first use."""

    def __missing__(self, word):
        self[word] = at = len(self)
        return at


def packed(words: list[bytes], *numbers: np.ndarray) -> bytes:
    """A word list with arrays of the same length, compressed."""
    parts = [np.array([len(words)], "<i8").tobytes(), np.fromiter(map(len, words), "<u4", len(words)).tobytes()]
    parts += [np.ascontiguousarray(x, "<i8").tobytes() for x in numbers]
    return zstandard.ZstdCompressor(level=3).compress(b"".join([*parts, *words]))


def unpacked(payload: bytes, numbers: int) -> tuple[list[bytes], list[np.ndarray]]:
    data = zstandard.ZstdDecompressor().decompress(payload)
    n = int(np.frombuffer(data, "<i8", 1)[0])
    at = 8 + 4 * n
    ends = np.cumsum(np.frombuffer(data, "<u4", n, 8), dtype=np.int64)
    arrays = [np.frombuffer(data, "<i8", n, at + 8 * n * i) for i in range(numbers)]
    at += 8 * n * numbers
    edges = [at, *(ends + at).tolist()]
    return [data[a:b] for a, b in zip(edges, edges[1:])], arrays


class WordBlocks:
    """``words`` (bucket, block, payload of words, their positions' steps and their counts by group) and the blocks' files."""

    def __init__(self, words: DataFrame, folder: str):
        self.words, self.folder = words, folder


def write_blocks(docs: DataFrame, splitter: Callable[[], Callable[[str], list]], key: str = "doc_id", text: str = "text", group: Column | None = None, groups: int = 0) -> WordBlocks:
    """Split every whole text by ``splitter()`` and write blocks and word lists once.

    ``group`` (0 to ``groups`` − 1) names the group in which a document's words are counted; null: in none. Null texts are empty: a row without words.
    A task that runs again writes files under new names, and the stored table names those of the attempt that counted.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = scratch_path(spark, "word-blocks")
    counted = F.lit(-1) if group is None else F.coalesce(group.cast("int"), F.lit(-1))
    buckets = max(BUCKETS, BUCKETS_PER_TASK * tasks(spark))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter()
        index, sink, writer, positions, seen, flagged = Numbers(), None, None, 0, [], []
        for batch in batches:
            keys, texts, of = batch.column(0), as_texts(batch.column(1)), batch.column(2).to_pylist()
            codes = [np.fromiter(map(index.__getitem__, split(t)), np.int32) for t in texts]
            if writer is None:
                schema = pa.schema([("key", keys.type), *((f"byte{i}", pa.list_(pa.uint8())) for i in range(3)), ("group", pa.int32()), ("bytes", pa.int64())])
                sink = pa.BufferOutputStream()
                writer = pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6)))
            ends = np.r_[0, np.cumsum([len(c) for c in codes])].astype(np.int32)
            flat = np.concatenate(codes) if codes else np.zeros(0, np.int32)
            # Numbers byte by byte: early numbers are frequent words, so the upper bytes compress to little.
            listed = lambda x: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x.astype(np.uint8)))
            writer.write_batch(pa.RecordBatch.from_arrays([keys, *(listed(flat >> (8 * i) & 0xFF) for i in range(3)), pa.array(of, pa.int32()), pc.binary_length(batch.column(1)).cast(pa.int64())], schema=schema))
            positions += len(flat)
            if groups:
                counts = np.bincount(np.concatenate([c.astype(np.int64) * groups + g for c, g in zip(codes, of) if g >= 0] or [np.zeros(0, np.int64)]), minlength=len(index) * groups)
                counts = np.ascontiguousarray(counts.reshape(-1, groups).T)
                for earlier in seen:
                    counts[:, : earlier.shape[1]] += earlier
                seen = [counts]
            if len(index) >= WORDS or positions >= POSITIONS:
                writer.close()
                yield from _close(index, sink.getvalue(), seen, groups, folder, buckets)
                index, writer, positions, seen = Numbers(), None, 0, []
        if writer is not None:
            writer.close()
            yield from _close(index, sink.getvalue(), seen, groups, folder, buckets)

    rows = docs.select(F.col(key), text_or_empty(text).alias("_text"), counted.alias("_group"))
    words = stored(rows.mapInArrow(run, "bucket int, block long, payload binary"), "block-words")
    return WordBlocks(words, folder)


def _close(index: dict, docs: pa.Buffer, seen: list[np.ndarray], groups: int, folder: str, buckets: int) -> Iterator[pa.RecordBatch]:
    block = secrets.randbits(62)
    write_whole(f"{folder}/{block}.docs", [docs])
    words = [w if isinstance(w, bytes) else w.encode() for w in index]
    counts = np.zeros((groups, len(words)), np.int64)
    for c in seen:
        counts[:, : c.shape[1]] += c
    bucket = np.fromiter((zlib.crc32(w) for w in words), np.uint32, len(words)) % buckets
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = []
    for b, lo, hi in zip(range(buckets), edges, edges[1:]):
        if hi > lo:
            at = order[lo:hi]
            rows.append((b, packed([words[i] for i in at], np.diff(at, prepend=0), *counts[:, at])))
    if not rows:  # a block of wordless texts still has to come back
        rows.append((0, packed([], *[np.zeros(0)] * (1 + groups))))
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([block] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
        names=["bucket", "block", "payload"],
    )


def by_bucket(words: DataFrame, fn: Callable[[int, Iterator[tuple]], Iterator[tuple]], schema: str, order: list[str] = ()) -> DataFrame:
    """Stream every bucket's rows, in one task and in ``order``, through ``fn(bucket, rows)``; ``words`` begins with the column bucket."""
    sorted_rows = words.repartition("bucket").sortWithinPartitions("bucket", *order)
    return sorted_rows.mapInArrow(_streamed(fn, schema), schema)


def by_block(answers: DataFrame, fn: Callable[[int, Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """The same by block, for the way back; ``answers`` begins with the column block."""
    return answers.repartition("block").sortWithinPartitions("block").mapInArrow(_streamed(fn, schema), schema)


def _streamed(fn, schema: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import groupby

        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        for name, group in groupby(rows(), key=lambda r: r[0]):
            yield from fn(name, group)

    return run


def texts_of(folder: str, block: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(keys, ends, codes) of a block, batch by batch; codes[ends[i]:ends[i + 1]] are the word numbers of text i."""
    for keys, ends, codes, *_ in texts_with_groups(folder, block):
        yield keys, ends, codes


def texts_with_groups(folder: str, block: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, ends, codes, groups, bytes): ``texts_of`` with every text's group, −1 where its words are counted in none, and its length."""
    with pa.ipc.open_stream(mapped(f"{folder}/{block}.docs")) as stream:
        for batch in stream:
            ends = batch.column(1).offsets.to_numpy()
            parts = [batch.column(1 + i).flatten().to_numpy().astype(np.int32) << (8 * i) for i in range(3)]
            yield batch.column(0), ends - ends[0], parts[0] | parts[1] | parts[2], batch.column(4).to_numpy(), batch.column(5).to_numpy()
