"""SimHash near duplicates: fingerprints in one pass, links by bit-sliced comparison inside exact blocks.

Fingerprints at ``radius`` or fewer differing bits agree on at least ``blocks − radius`` of ``blocks`` bit blocks, so
a key for every choice of that many blocks misses no pair. Within a key, bit planes are stored vertically: one plane
holds one bit of all fingerprints, packed; XOR with a query bit marks the differing ones, and carry-save counters
add up the marks of all of them at once. A run of words whose every lane exceeds the radius is abandoned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from panelforge.llm.common import as_texts, components, small_batches, stored, text_or_empty

SEED = 42
SHINGLE = 4
#: Distinct fingerprints that one comparison holds; a larger key is split into parts that meet in pairs.
PART = 2048


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half the hashes of the word shingles (repeats included); no words: 0."""
    words = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes).tolist()
    last = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(joined[a:b], SEED) for a, b in zip(starts, last)], np.uint64, len(last))
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[lo : lo + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return sum(1 << i for i in range(64) if 2 * int(ones[i]) > len(hashes))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, fp long) of every whole text; null and empty texts have 0. Narrow."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t, shingle) for t in as_texts(batch.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=[key, "fp"])

    return docs.select(key, text_or_empty(text).alias("_text")).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, fp long")


def planes(values: np.ndarray) -> np.ndarray:
    """64 rows of packed bits: lane j of row i is bit i of value j."""
    lanes = -(-len(values) // 64) * 64
    bits = np.zeros((lanes, 64), np.uint8)
    bits[: len(values)] = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def within(queries: np.ndarray, table: np.ndarray, radius: int, slab: int = 64) -> Iterator[tuple[int, np.ndarray]]:
    """(query, lanes of ``table`` at ``radius`` or fewer differing bits) for queries that have any.

    All queries run at once against the planes, one bit position at a time. Counters are vertical too: ``ones``,
    ``twos``, ``fours`` hold each lane's distance, and ``over`` the lanes that passed the radius. A query whose lanes are all over is abandoned.
    """
    if radius > 6:
        raise ValueError("counters hold distances up to 7")
    rows = planes(table)
    lanes = rows.shape[1]
    for lo in range(0, len(queries), slab):
        live = np.arange(lo, min(len(queries), lo + slab))
        digits = [np.zeros((len(live), lanes), np.uint64) for _ in range(3)]
        over = np.zeros((len(live), lanes), np.uint64)
        for bit in range(64):
            flip = np.where(queries[live] >> np.uint64(bit) & np.uint64(1), ~np.uint64(0), np.uint64(0))
            carry = rows[bit][None, :] ^ flip[:, None]
            for d in range(3):
                digits[d], carry = digits[d] ^ carry, digits[d] & carry
            over |= carry | _above(digits, radius)
            if bit % 8 == 7 and bit >= 15:
                keep = (over != ~np.uint64(0)).any(axis=1)
                if not keep.all():
                    live, over, digits = live[keep], over[keep], [d[keep] for d in digits]
                if not len(live):
                    break
        if len(live):
            near = np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little")[:, : len(table)]
            for i, row in zip(live, near):
                if row.any():
                    yield int(i), np.flatnonzero(row)


def _above(digits: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose three-digit counter exceeds ``radius``: compared from the highest digit down."""
    above, equal = np.uint64(0), ~np.uint64(0)
    for d in (2, 1, 0):
        if radius >> d & 1:
            equal = equal & digits[d]
        else:
            above = above | (equal & digits[d])
            equal = equal & ~digits[d]
    return above


class _Joined:
    """Union of positions; ``links`` gives at most one per position."""

    def __init__(self, size: int):
        self.root = list(range(size))

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.root[max(i, j)] = min(i, j)

    def links(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.array([i for i, r in enumerate(self.root) if r != i], np.int64)
        return values[at], values[[self.find(i) for i in at]]


def _large_group(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what lies within the radius in ``a`` (or between ``a`` and ``b``)."""
    joined = _Joined(len(a) + (0 if b is None else len(b)))
    shift = 0 if b is None else len(a)
    for i, lanes in within(a, a if b is None else b, radius):
        for j in lanes.tolist():
            joined.join(i, j + shift)
    return joined.links(a if b is None else np.concatenate([a, b]))


def _small_groups(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for many groups of at most 64 at once: a group is one word of 64 lanes, its members are queries in turn."""
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    place = starts[:, None] + np.arange(64)[None, :]
    filled = np.arange(64)[None, :] < sizes[:, None]
    member = np.where(filled, values[np.minimum(place, len(values) - 1)], np.uint64(0))
    bits = np.unpackbits(member.astype("<u8").view(np.uint8).reshape(len(starts), 64, 8), axis=2, bitorder="little")
    rows = np.packbits(np.ascontiguousarray(bits.transpose(2, 0, 1)), axis=2, bitorder="little").view("<u8")[:, :, 0]
    lanes = np.packbits(filled, axis=1, bitorder="little").view("<u8")[:, 0]
    joined = _Joined(len(values))
    for i in range(int(sizes[0]) if len(sizes) else 0):
        live = int((sizes > i + 1).sum())  # sizes fall, so these come first; earlier lanes were compared from their side
        digits = [np.zeros(live, np.uint64) for _ in range(3)]
        over = np.zeros(live, np.uint64)
        own = member[:live, i]
        for bit in range(64):
            flip = np.where(own >> np.uint64(bit) & np.uint64(1), ~np.uint64(0), np.uint64(0))
            carry = rows[bit, :live] ^ flip
            for d in range(3):
                digits[d], carry = digits[d] ^ carry, digits[d] & carry
            over |= carry | _above(digits, radius)
        near = ~over & lanes[:live] & ~np.uint64((1 << (i + 1)) - 1)
        for g in np.flatnonzero(near):
            mask, first = int(near[g]), int(starts[g])
            while mask:
                low = mask & -mask
                joined.join(first + i, first + low.bit_length() - 1)
                mask ^= low
    return joined.links(values)


def key_plan(distinct: int, radius: int) -> tuple[int, int]:
    """(blocks, blocks per key): the fewest keys whose values hold some 2,000 fingerprints on average at most.

    Every choice finds the same links; more fingerprints only take longer keys.
    """
    for extra in range(1, 5):
        blocks = radius + extra
        if extra * 64 / blocks >= log2(max(distinct, 2)) - 11:
            break
    return blocks, extra


def fingerprint_links(distinct: DataFrame, radius: int, part: int = PART) -> DataFrame:
    """(a, b) links between distinct fingerprints (column fp) that join whatever ``radius`` joins.

    A key that many fingerprints share is split: its fingerprints are dealt into parts by hash and every pair of parts is
    compared by a task of its own, so no task holds more than two parts and no pairs are emitted.
    """
    blocks, per_key = key_plan(distinct.count(), radius)
    edges = [64 * i // blocks for i in range(blocks + 1)]
    part_of = lambda b: F.expr(f"shiftrightunsigned(fp, {edges[b]}) & {(1 << edges[b + 1] - edges[b]) - 1}L")
    key = [F.struct(F.lit(n).alias("n"), F.xxhash64(F.lit(n), *[part_of(b) for b in chosen]).alias("h")) for n, chosen in enumerate(combinations(range(blocks), per_key))]
    keyed = distinct.select("fp", F.explode(F.array(*key)).alias("k")).select("fp", "k.n", "k.h")
    sizes = keyed.groupBy("n", "h").count().filter("count > 1").select("n", "h", F.ceil(F.col("count") / part).cast("int").alias("parts"))
    dealt = keyed.join(sizes, ["n", "h"]).withColumn("p", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts")).cast("int"))
    # Part p meets every part q: the task (min, max) gets both.
    meets = F.expr("transform(sequence(0, parts - 1), q -> struct(least(p, q) AS lo, greatest(p, q) AS hi))")
    met = dealt.select("fp", "n", "h", "p", F.explode(meets).alias("m")).select("fp", "n", "h", "p", "m.lo", "m.hi")
    grouped = met.repartition("n", "h", "lo", "hi").sortWithinPartitions("n", "h", "lo", "hi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fp, p, lo, hi, edges in _whole_groups(batches):
            values, sizes = fp.view(np.uint64), np.diff(edges)
            small = np.flatnonzero((sizes > 1) & (sizes <= 64) & (lo[edges[:-1]] == hi[edges[:-1]]))
            found = [_small_groups(values, edges[small], sizes[small], radius)] if len(small) else []
            for g in np.flatnonzero((sizes > 64) | (lo[edges[:-1]] != hi[edges[:-1]])):
                x, side = values[edges[g] : edges[g + 1]], p[edges[g] : edges[g + 1]]
                if lo[edges[g]] == hi[edges[g]]:
                    found.append(_large_group(x, None, radius))
                else:
                    found.append(_large_group(x[side == lo[edges[g]]], x[side != lo[edges[g]]], radius))
            for a, b in found:
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return grouped.select("fp", "n", "h", "p", "lo", "hi").mapInArrow(run, "a long, b long").distinct()


def _whole_groups(batches: Iterator[pa.RecordBatch], rows: int = 1 << 15) -> Iterator[tuple]:
    """Rows sorted by (n, h, lo, hi) in stretches of whole groups, with the edges of the groups."""
    held: list[list[np.ndarray]] = []

    def stretch(final: bool) -> tuple | None:
        fp, n, h, p, lo, hi = (np.concatenate(c) for c in zip(*held))
        change = np.flatnonzero((n[1:] != n[:-1]) | (h[1:] != h[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
        edges = np.r_[0, change, len(fp)] if final else np.r_[0, change]
        held[:] = [[c[edges[-1] :] for c in (fp, n, h, p, lo, hi)]]
        return (fp, p, lo, hi, edges) if len(edges) > 1 and len(fp) else None

    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        if sum(len(c[0]) for c in held) >= rows and (found := stretch(False)):
            yield found
    if held and (found := stretch(True)):
        yield found


def simhash_groups(docs: DataFrame, radius: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint, component_id): the smallest key reachable over links of ``radius`` or fewer differing bits.

    Equal fingerprints collapse before anything is compared, so a group of copies is one fingerprint. Null, empty and
    wordless texts share fingerprint 0 and are linked like any other. Repeated keys stay separate rows. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    marked = stored(fingerprints(docs, key, text), "fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min(key).alias("first")), "distinct-fingerprints")
    links = fingerprint_links(distinct.select("fp"), radius)
    roots = components(links)
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = named.join(least, "root").select("fp", "component_id")
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return marked.join(of_fp, "fp").select(key, shown.alias("fingerprint"), "component_id")


def near_duplicate_free(docs: DataFrame, radius: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row per group: the one with the smallest key, null keys last, then by a hash of the whole row.

    Rows are told apart by that hash, so different texts under one key are judged each for itself; of equal rows one stays.
    """
    # A null leaves the hash as it was, so which columns are null goes in too.
    row = F.xxhash64(*docs.columns, *[F.col(c).isNull() for c in docs.columns])
    identity = F.struct(F.col(key).isNull().alias("no_key"), F.col(key).alias("key"), row.alias("row"))
    groups = simhash_groups(docs.select(identity.alias("_id"), F.col(text).alias("_body")), radius, "_id", "_body")
    stay = groups.filter(F.col("_id") == F.col("component_id")).groupBy(F.col("_id.row").alias("_row")).agg((F.count(F.lit(1)) > 1).alias("_again"))
    kept = docs.withColumn("_row", row).join(stay, "_row")
    single, repeated = (kept.filter(c).select(*docs.columns) for c in (~F.col("_again"), F.col("_again")))
    return single.unionByName(repeated.dropDuplicates())
