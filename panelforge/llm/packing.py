"""Packing of tokenized documents into sequences of a fixed capacity by minimum bin slack.

A document longer than a sequence is cut at multiples of the capacity; full pieces are sequences of their own. The
remainders are packed in groups of bounded size: each bin starts with the longest remainder left, then a subset-sum
table over a window of the next lengths (one bit per reachable sum, as one long integer) finds the multiset that
comes closest to capacity, and backtracking over the table's rows gives how many of each length it takes.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from panelforge.llm.common import as_texts, small_batches, stored, tasks, text_or_empty
from panelforge.llm.tokens import encoder

PIECES = "doc_id long, copy long, start long, length long, ids_crc32 long, doc_tokens long"
PLACES = "doc_id long, copy long, start long, bin long, offset long"
#: Pieces of one group: enough lengths for full bins, few enough for one task's memory.
GROUP = 4096
#: Distinct lengths that one bin's table looks at, and how many of each.
WINDOW, TIMES = 48, 4


def fill(capacity: int, counts: dict[int, int], lengths: list[int]) -> list[tuple[int, int]]:
    """[(length, times)] of a multiset within ``counts`` whose sum is closest to ``capacity``, not above it.

    ``lengths`` is the window in descending order; the table stops early once the capacity itself is reached.
    """
    mask, reach, rows, full = (1 << (capacity + 1)) - 1, 1, [], 1 << capacity
    for size in lengths:
        for _ in range(min(counts[size], TIMES, capacity // size)):
            rows.append((size, reach))
            reach |= (reach << size) & mask
            if reach & full:
                break
        if reach & full:
            break
    at, taken = reach.bit_length() - 1, {}
    for size, before in reversed(rows):
        if not before >> at & 1:  # only reachable with this item
            taken[size] = taken.get(size, 0) + 1
            at -= size
    return list(taken.items())


def minimum_bin_slack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item indexes; every item is in exactly one bin and no bin holds more than ``capacity``."""
    of: dict[int, list[int]] = {}
    for i in range(len(sizes) - 1, -1, -1):
        of.setdefault(sizes[i], []).append(i)
    counts = {s: len(v) for s, v in of.items()}
    ascending = sorted(of)
    bins = []

    def take(size: int, into: list[int]) -> None:
        into.append(of[size].pop())
        counts[size] -= 1
        if not counts[size]:
            del ascending[bisect_right(ascending, size) - 1]

    while ascending:
        own: list[int] = []
        room = capacity - ascending[-1]
        take(ascending[-1], own)
        while room and ascending and ascending[0] <= room:
            top = bisect_right(ascending, room)
            # Half the window from the longest that fit, half from the shortest: coarse filling and fine adjustment.
            window = ascending[:top] if top <= WINDOW else ascending[: WINDOW // 2] + ascending[top - WINDOW // 2 : top]
            for size, times in fill(room, counts, window[::-1]):
                for _ in range(times):
                    take(size, own)
                    room -= size
        bins.append(own)
    return bins


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text, append ``end_id`` and cut at multiples of ``capacity``: one row per piece with its span and checksum.

    Null texts are empty (the end id alone). ``copy`` tells repeated rows of one key apart. Narrow: no shuffle.
    """
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            out = []
            for k, copy, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), enc.encode(as_texts(batch.column(1)))):
                row = np.frombuffer(ids + end, enc.dtype).astype("<u4")
                for lo in range(0, len(row), capacity):
                    piece = row[lo : lo + capacity]
                    out.append((k, copy, lo, len(piece), zlib.crc32(piece.tobytes()), len(row)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["doc_id", "copy", "start", "length", "ids_crc32", "doc_tokens"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("_text"), F.monotonically_increasing_id().alias("copy"))
    return rows.mapInArrow(cut, PIECES)


def pack(pieces: DataFrame, capacity: int = 4096, group: int = GROUP) -> DataFrame:
    """``pieces`` (doc_id, copy, start, length …) with sequence_id and offset.

    Sequences are gapless; sequence ids count from 0 without holes. Groups are dealt by hash of the piece, so none
    depends on a key that many rows share. Two rounds: bins of the first that keep a slack of over 1 % are opened again and packed
    anew in groups of their own, so the padding left is one unfilled bin per group of the second round.
    A piece of length 0 or above ``capacity`` is an error; an empty table gives an empty result.
    """
    pieces = stored(pieces, "pieces")
    parts = pieces.filter(F.col("length") < capacity)
    first = stored(_packed(parts, capacity, group), "packed-1")
    used = first.groupBy("bin").agg(F.sum("length").alias("_used"))
    first = first.join(used, "bin")
    done = first.filter(F.col("_used") >= 0.99 * capacity).select("doc_id", "copy", "start", "bin", "offset")
    again = first.filter(F.col("_used") < 0.99 * capacity).select("doc_id", "copy", "start", "length")
    second = _packed(again, capacity, group).select("doc_id", "copy", "start", (-1 - F.col("bin")).alias("bin"), "offset")
    places = stored(done.unionByName(second).unionByName(
        pieces.filter(F.col("length") >= capacity).select("doc_id", "copy", "start", F.lit(None).cast("long").alias("bin"), F.lit(0).cast("long").alias("offset"))
    ), "placed")
    return pieces.join(_numbered(places), ["copy", "start"])  # copy alone names the row: keys may be null or repeat


def _packed(parts: DataFrame, capacity: int, group: int) -> DataFrame:
    total = parts.count()
    groups = max(1, -(-total // group))

    def one(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values(["length", "doc_id", "copy", "start"], ignore_index=True)
        where, offset = np.zeros(len(table), np.int64), np.zeros(len(table), np.int64)
        lengths = table["length"].tolist()
        for b, items in enumerate(minimum_bin_slack(lengths, capacity)):
            at = 0
            for i in items:
                where[i], offset[i] = b, at
                at += lengths[i]
        return table[["doc_id", "copy", "start", "length"]].assign(bin=(int(table["g"].iloc[0]) << 24) + where, offset=offset)

    dealt = parts.select("doc_id", "copy", "start", "length", F.pmod(F.xxhash64("doc_id", "copy", "start"), F.lit(groups)).alias("g"))
    return dealt.groupBy("g").applyInPandas(one, "doc_id long, copy long, start long, length long, bin long, offset long")


def _numbered(places: DataFrame) -> DataFrame:
    """Bins become sequence ids from 0 on: prefix sums over the counts of hashed slots, then a rank within each slot."""
    # A full piece is a bin of its own, named by its place; negative bins are those of the second round.
    name = F.coalesce(F.col("bin").cast("string"), F.concat_ws("_", "copy", "start"))
    named = places.withColumn("_bin", name)
    bins = named.select("_bin").distinct().withColumn("_slot", F.pmod(F.xxhash64("_bin"), F.lit(4 * tasks(places.sparkSession))))
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    bases = bins.groupBy("_slot").count().select("_slot", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    rank = F.row_number().over(Window.partitionBy("_slot").orderBy("_bin")) - 1
    ids = bins.withColumn("_rank", rank).join(bases, "_slot").select("_bin", (F.col("_base") + F.col("_rank")).cast("long").alias("sequence_id"))
    return named.join(ids, "_bin").select("copy", "start", "sequence_id", "offset")
