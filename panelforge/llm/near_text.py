"""Near-duplicate texts by SimHash and exact verification: five-word shingles, Jaccard similarity of 0.8 or more.

At similarity 0.8 some 19 of 128 fingerprint bits differ, too many for blocks that must agree exactly. So fingerprints meet in
tables of sampled bits: longer keys and more tables as there are more of them. What meets is compared bit-sliced:
planes hold one bit of all fingerprints, carry-save adders count the differing ones of all lanes together, and a run is abandoned once
every lane is over the radius. Pairs found only join candidate groups; inside a group shingle sets are compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from panelforge.llm.common import as_texts, components, small_batches, stored, text_or_empty

SHINGLE, SIMILARITY = 5, 0.8
BITS = 128
#: Differing bits of a candidate: 3 deviations above the mean of a pair at similarity 0.8; unrelated texts differ in 64 ± 6.
RADIUS = 31
#: Share of equal bits of such a pair (angle between the sets' votes), fingerprints a key is to hold, and how rarely all tables miss it.
AGREE, BUCKET, MISS = 0.848, 1024, 0.001
#: Fingerprints, and shingle sets, of one part; larger groups are split and their parts meet in pairs.
PART, SET_PART = 2048, 512
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles (A-Z lower-cased); fewer words: the whole sequence; none: empty."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts, last = (ends - sizes).tolist(), ends[min(size, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter([digest(joined[a:b]) for a, b in zip(starts, last)], np.uint64, len(last)))


def fingerprint(codes: np.ndarray) -> tuple[int, int]:
    """Two 64-bit words: a bit is 1 if over half of the set's hashes have it."""
    out = []
    for word in range(BITS // 64):
        ones = np.zeros(64, np.int64)
        for lo in range(0, len(codes), 1 << 15):
            h = codes[lo : lo + (1 << 15)]
            if word:  # a second hash of the same shingle
                h = (h ^ (h >> np.uint64(31))) * _MIX
                h ^= h >> np.uint64(29)
            bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int32)
        out.append(int(np.packbits(2 * ones > len(codes), bitorder="little").view("<i8")[0]))
    return out[0], out[1]


def _planes(words: np.ndarray) -> np.ndarray:
    """``BITS`` rows of packed bits from (n, 2) words: lane j of row i is bit i of fingerprint j."""
    lanes = -(-len(words) // 64) * 64
    bits = np.zeros((lanes, BITS), np.uint8)
    bits[: len(words)] = np.unpackbits(words.astype("<u8").view(np.uint8).reshape(-1, BITS // 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def _add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save adder: (carry, sum) of three bits in every lane."""
    half = a ^ b
    return (a & b) | (half & c), half ^ c


def within(queries: np.ndarray, table: np.ndarray, slab: int = 512) -> Iterator[tuple[int, np.ndarray]]:
    """(query, lanes of ``table`` at ``RADIUS`` or fewer differing bits) for queries that have any; both are (n, 2) words."""
    rows = _planes(table)
    bits = np.unpackbits(queries.astype("<u8").view(np.uint8).reshape(-1, BITS // 8), axis=1, bitorder="little").astype(bool)
    full = ~np.uint64(0)
    for lo in range(0, len(queries), slab):
        live = np.arange(lo, min(len(queries), lo + slab))
        flips = np.where(bits[live], full, np.uint64(0))
        ones, twos, fours, eights, sixteens, over = (np.zeros((len(live), rows.shape[1]), np.uint64) for _ in range(6))
        for first in range(0, BITS, 8):
            d = [rows[i][None, :] ^ flips[:, i, None] for i in range(first, first + 8)]
            a, ones = _add(ones, d[0], d[1])
            b, ones = _add(ones, d[2], d[3])
            c, twos = _add(twos, a, b)
            a, ones = _add(ones, d[4], d[5])
            b, ones = _add(ones, d[6], d[7])
            e, twos = _add(twos, a, b)
            carry, fours = _add(fours, c, e)
            eights, carry = eights ^ carry, eights & carry
            sixteens, carry = sixteens ^ carry, sixteens & carry
            over |= carry  # 32 and more
            if first >= 56:
                keep = (over != full).any(axis=1)
                if not keep.any():
                    break
                if keep.sum() * 2 < len(live):
                    live, flips, ones, twos, fours, eights, sixteens, over = (x[keep] for x in (live, flips, ones, twos, fours, eights, sixteens, over))
        else:
            near = np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little")[:, : len(table)]
            for i, row in zip(live, near):
                if row.any():
                    yield int(i), np.flatnonzero(row)


class _Union:
    def __init__(self, size: int):
        self.root = list(range(size))

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        self.root[max(i, j)] = min(i, j)

    def links(self) -> list[tuple[int, int]]:
        """At most one per member."""
        return [(i, r) for i in range(len(self.root)) if (r := self.find(i)) != i]


def table_plan(distinct: int) -> tuple[int, int]:
    """(bits per key, tables) for so many fingerprints: keys hold some ``BUCKET`` of them, and all tables together miss a pair at
    the similarity with probability ``MISS`` beyond what the radius leaves out."""
    bits = max(1, math.ceil(math.log2(max(2, distinct / BUCKET))))
    return bits, math.ceil(math.log(1 / MISS) / AGREE**bits)


def _sampled_keys(distinct: int) -> Column:
    """Array of (table, key): the fingerprint's bits at each table's places."""
    bits, tables = table_plan(distinct)
    keys = []
    for t in range(tables):
        places = np.random.default_rng([t, bits]).permutation(BITS)[:bits].tolist()
        masks = [sum(1 << p % 64 for p in places if p // 64 == w) for w in range(2)]
        signed = [m - (1 << 64) if m >> 63 else m for m in masks]
        keys.append(f"named_struct('n', {t}, 'h', xxhash64({t}, w0 & {signed[0]}L, w1 & {signed[1]}L))".replace("-9223372036854775808L", "(-9223372036854775807L - 1L)"))
    return F.expr(f"array({', '.join(keys)})")


def _parted(rows: DataFrame, group: list[str], part: int, spread: list[str]) -> DataFrame:
    """Rows of groups of two or more, each in all meetings (lo, hi) of its group's parts; sorted so that a meeting is one run of rows."""
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*group, F.ceil(F.col("_n") / part).cast("int").alias("_parts"))
    dealt = rows.join(sizes, group).withColumn("p", F.pmod(F.xxhash64(*spread, F.lit(7)), F.col("_parts")).cast("int"))
    meets = F.expr("transform(sequence(0, _parts - 1), q -> struct(least(p, q) AS lo, greatest(p, q) AS hi))")
    met = dealt.withColumn("_m", F.explode(meets)).select(*rows.columns, "p", "_m.lo", "_m.hi")
    # In node order the smallest node of what a run unites is its root: runs that hold the same nodes give the same links.
    return met.repartition(*group, "lo", "hi").sortWithinPartitions(*group, "lo", "hi", "node")


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys as one table each; batches are cut where the keys change."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(max(0, batch.num_rows - 1), bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        for lo, hi in zip([0, *(np.flatnonzero(change) + 1).tolist()], [*(np.flatnonzero(change) + 1).tolist(), batch.num_rows]):
            if hi == lo:
                continue
            key = tuple(c[lo] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def candidate_links(distinct: DataFrame) -> DataFrame:
    """(a, b) links between nodes (columns node, w0, w1) that join what lies within the radius and meets in a table.

    A table's key with many fingerprints is split: every pair of its parts is a task's run of its own, and a run emits at most one
    link per fingerprint. Nodes with equal fingerprints meet in every table.
    """
    keyed = distinct.select("node", "w0", "w1", F.explode(_sampled_keys(distinct.count())).alias("_k")).select("node", "w0", "w1", "_k.n", "_k.h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ["n", "h", "lo", "hi"]):
            words = np.column_stack([table.column(c).to_numpy() for c in ("w0", "w1")]).view(np.uint64)
            side = table.column("p").to_numpy() == table.column("lo")[0].as_py()
            union = _Union(len(words))
            if side.all() and table.column("hi")[0].as_py() == table.column("lo")[0].as_py():
                x = y = np.arange(len(words))
            else:
                x, y = np.flatnonzero(side), np.flatnonzero(~side)
            if len(x) and len(y):
                for i, lanes in within(words[x], words[y]):
                    for j in y[lanes].tolist():
                        union.join(int(x[i]), j)
            if pairs := union.links():
                nodes = table.column("node").to_pylist()
                yield pa.RecordBatch.from_pydict({"a": pa.array([nodes[i] for i, _ in pairs], pa.int64()), "b": pa.array([nodes[j] for _, j in pairs], pa.int64())})

    return _parted(keyed, ["n", "h"], PART, ["node"]).select("node", "w0", "w1", "n", "h", "p", "lo", "hi").mapInArrow(run, "a long, b long").distinct()


def thinned(links: DataFrame) -> DataFrame:
    """The same groups from fewer links: a node keeps the smallest node it is linked to, its other partners are linked to that one.

    Runs of different tables and parts name different smallest members of one group, few for all its nodes; so what was a link per
    node and run becomes one per node and one per such member."""
    stars = links.groupBy("a").agg(F.min("b").alias("m"), F.collect_set("b").alias("bs"))
    pair = lambda a: F.struct(a.alias("a"), F.col("m").alias("b"))
    pairs = F.concat(F.array(pair(F.col("a"))), F.transform("bs", pair))
    return stars.select(F.explode(pairs).alias("p")).select("p.a", "p.b").filter("a <> b").distinct()


def verified_links(sets: DataFrame) -> DataFrame:
    """(a, b) links inside candidate groups (columns node, root, codes: sorted distinct hashes as bytes) that join all pairs whose
    Jaccard similarity reaches 0.8; a pair is skipped only where verified links join it already."""

    def similar(a: np.ndarray, b: np.ndarray) -> bool:
        small, large = (a, b) if len(a) <= len(b) else (b, a)
        if len(small) < SIMILARITY * len(large) or not len(small):
            return False
        at = np.minimum(np.searchsorted(large, small), len(large) - 1)
        shared = int((large[at] == small).sum())
        return shared >= SIMILARITY * (len(a) + len(b) - shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ["root", "lo", "hi"]):
            codes = [np.frombuffer(x, "<u8") for x in table.column("codes").to_pylist()]
            side = table.column("p").to_numpy() == table.column("lo")[0].as_py()
            same = table.column("hi")[0].as_py() == table.column("lo")[0].as_py()
            union = _Union(len(codes))
            x = np.arange(len(codes)) if same else np.flatnonzero(side)
            y = x if same else np.flatnonzero(~side)
            for i in x.tolist():
                for j in y.tolist():
                    if (j > i or not same) and union.find(i) != union.find(j) and similar(codes[i], codes[j]):
                        union.join(i, j)
            if pairs := union.links():
                nodes = table.column("node").to_pylist()
                yield pa.RecordBatch.from_pydict({"a": pa.array([nodes[i] for i, _ in pairs], pa.int64()), "b": pa.array([nodes[j] for _, j in pairs], pa.int64())})

    return _parted(sets, ["root"], SET_PART, ["node"]).select("node", "root", "codes", "p", "lo", "hi").mapInArrow(run, "a long, b long").distinct()


def near_text_groups(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, root) of every row: rows with one root are joined by pairs of texts whose shingle sets are equal or 0.8 similar.

    Equal sets collapse first. Null, empty and wordless texts are one set. The key may be a struct; repeated keys stay separate rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[key].dataType.simpleString()

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t) for t in as_texts(batch.column(1))]
            words = [fingerprint(s) for s in sets]
            names = [xxhash.xxh128_hexdigest(s.tobytes()) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names), pa.array([w[0] for w in words], pa.int64()), pa.array([w[1] for w in words], pa.int64())], [key, "name", "w0", "w1"]
            )

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t).astype("<u8").tobytes() for t in as_texts(batch.column(3))]
            # Rows may share a key: only the set that is meant goes on.
            mine = pa.array([xxhash.xxh128_hexdigest(s) == name for s, name in zip(sets, batch.column(2).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.binary())], ["node", "root", "codes"]).filter(mine)

    rows = docs.select(key, text_or_empty(text).alias("_text"))
    marked = stored(rows.mapInArrow(marks, f"`{key}` {kind}, name string, w0 long, w1 long"), "shingle-marks")
    least = marked.groupBy("name").agg(F.min(F.struct("w0", "w1", F.col(key).alias("k"))).alias("m"))
    # Numbers instead of names keep what is shuffled small; they are stored, so they never change.
    distinct = stored(least.select(F.monotonically_increasing_id().alias("node"), "name", "m.w0", "m.w1", "m.k"), "shingle-sets")
    groups = components(thinned(candidate_links(distinct.select("node", "w0", "w1"))))
    # One text of every set that has a candidate, found by its key.
    wanted = distinct.join(groups, "node").select("node", "root", "name", F.col("k").alias(key))
    found = rows.join(wanted, rows[key].eqNullSafe(wanted[key])).select("node", "root", "name", "_text")
    again = stored(found.mapInArrow(codes, "node long, root long, codes binary"), "candidate-sets")
    roots = components(thinned(verified_links(again.dropDuplicates(["node"])))).withColumnRenamed("root", "_r")
    named = distinct.join(roots, "node", "left").select("name", F.coalesce("_r", "node").alias("root"))
    return marked.select(key, "name").join(named, "name").select(key, "root")


def near_duplicate_free(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row per group: the one with the smallest key, null keys last, then by a hash of the whole row.

    Rows are told apart by that hash, so different texts under one key are judged each for itself; of equal rows one stays.
    Null, empty and wordless texts are copies of each other; an empty table stays empty; all columns are kept as they are.
    """
    # A null leaves the hash as it was, so which columns are null goes in too.
    row = F.xxhash64(*docs.columns, *[F.col(c).isNull() for c in docs.columns])
    identity = F.struct(F.col(key).isNull().alias("no_key"), F.col(key).alias("key"), row.alias("row"))
    groups = near_text_groups(docs.select(identity.alias("_id"), F.col(text).alias("_body")), "_id", "_body")
    first = groups.groupBy("root").agg(F.min("_id").alias("_id"))
    stay = groups.join(first, ["root", "_id"], "left_semi").groupBy(F.col("_id.row").alias("_row")).agg((F.count(F.lit(1)) > 1).alias("_again"))
    kept = docs.withColumn("_row", row).join(stay, "_row")
    single, repeated = (kept.filter(c).select(*docs.columns) for c in (~F.col("_again"), F.col("_again")))
    return single.unionByName(repeated.dropDuplicates())
