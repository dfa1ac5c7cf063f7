"""Duplicate detection: URL keys, similar titles, SimHash content and the layered decision.

All near-duplicate operators use one idea, ``first_come``: records are processed in id order and a
record is an original unless an earlier original matches it. Matches are found between distinct values,
by joins that miss no pair, and no group of records is gathered in one task.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelforge import catalog
from panelforge.functions import text as tx, urls
from panelforge.operators import ordering
from panelforge.operators.set_join import rarest_first, similar_sets
from panelforge.session import cut_lineage, spread_out

def first_by_key(df: DataFrame, key: Column, order: str) -> DataFrame:
    """Batch form of a seen-set: (key, first id, copies) - one partial-aggregated group per key."""
    return df.groupBy(key.alias("key")).agg(F.min(order).alias("original"), F.count(F.lit(1)).alias("copies"))


def url_key(url: Column) -> Column:
    return F.sha1(urls.dedup_url(url))


# ---------------------------------------------------------------- signatures


#: Votes are counted three bits to a number, in lanes of 21 bits; so many tokens of one text at most are added up in one row.
_LANE, _LANES = 21, 1 | 1 << 21 | 1 << 42
_STRETCH = 20


def simhash(df: DataFrame, key: str, text: str, window: int | None = None) -> DataFrame:
    """(key, simhash): bit votes of the md5 of every whitespace token of the text.

    The whole text is read; ``window`` limits it to its first characters where a caller wants the classic setting.
    Votes add up map-side: the shuffle carries 22 packed counters per text (and per 2^20 tokens of a longer one), not its tokens.
    """
    body = F.substring(F.col(text), 1, window) if window else F.col(text)
    tokens = spread_out(df.select(key, text)).select(key, F.posexplode(tx.words(F.lower(body))).alias("_at", "t")).select(key, F.shiftright("_at", _STRETCH).alias("_stretch"), F.md5("t").alias("_h"))
    half = lambda start: F.conv(F.substring("_h", start, 8), 16, 10).cast("long")
    hashed = tokens.select(key, "_stretch", F.shiftleft(half(17), 32).bitwiseOR(half(25)).alias("_h"))
    lanes = lambda b: F.sum(F.shiftrightunsigned("_h", b).bitwiseAND(F.lit(_LANES))).alias(f"c{b}")
    packed = hashed.groupBy(key, "_stretch").agg(F.count(F.lit(1)).alias("n"), *[lanes(b) for b in range(_LANE)], F.sum(F.shiftrightunsigned("_h", 63)).alias("c63"))
    lane = lambda b: F.col("c63") if b == 63 else F.shiftrightunsigned(f"c{b % _LANE}", b // _LANE * _LANE).bitwiseAND(F.lit((1 << _LANE) - 1))
    votes = packed.groupBy(key).agg(F.sum("n").alias("n"), *[F.sum(lane(b)).alias(f"b{b}") for b in range(64)])
    value = F.lit(0).cast("long")
    for b in range(64):
        value = value.bitwiseOR(F.when(2 * F.col(f"b{b}") > F.col("n"), F.shiftleft(F.lit(1).cast("long"), b)).otherwise(0))
    return votes.select(key, value.alias("simhash"))


# Seven blocks of bits. Two words at distance ≤ 4 agree on at least three whole blocks, so the
# combinations of three find every such pair, and a key of 27 or more bits hardly ever joins others.
BLOCKS = [(0, 9), (9, 9), (18, 9), (27, 9), (36, 9), (45, 9), (54, 10)]
SIMHASH_DISTANCE = 4


def simhash_buckets(value: Column) -> Column:
    def mask(blocks: tuple[tuple[int, int], ...]) -> int:
        bits = sum(((1 << width) - 1) << start for start, width in blocks)
        return bits - (1 << 64) if bits >= 1 << 63 else bits

    choices = combinations(BLOCKS, len(BLOCKS) - SIMHASH_DISTANCE)
    return F.array(
        *[F.xxhash64(F.lit(f"c{i}"), value.bitwiseAND(F.lit(mask(c)).cast("long"))) for i, c in enumerate(choices)]
    )


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


# ---------------------------------------------------------------- election

#: Records of the first batch of an election, and how much longer the records settled so far get with each further batch.
FIRST_BATCH, GROWTH = 65536, 8
#: Links per value above which a batch is taken in smaller steps, estimated from about so many of its values.
DENSE, SAMPLE = 64, 2048
#: Once so few rows of holders and links are open, one task settles the rest in order instead of a job per round.
TAIL = 200_000


@dataclass
class Layer:
    """One way to match. ``values`` has a unique ``vid`` (text) with what ``near`` compares.

    ``near(left, right)`` gives (a, b) of all matching pairs of different vids, a of ``left`` and b of ``right``; with ``right``
    None each pair inside ``left`` at least once. ``near`` None: only equal values match. Equal values always match.
    """

    values: DataFrame
    near: Callable[[DataFrame, DataFrame | None], DataFrame] | None = None


def first_come(records: DataFrame, key: str, vids: list[str], layers: list[Layer], first_batch: int | None = None) -> DataFrame:
    """(key, original, layer) of every record, taken in ascending key order: a record is an original unless an earlier original matches it.

    ``vids`` names a record's value in each layer (null: it takes no part there). ``layer`` is the first layer with a match and
    ``original`` the smallest matching original of that layer; both are null for originals. Keys are unique.

    Records are settled in batches of growing length. A batch first meets the originals found so far, so a group of copies, or
    of titles that all match, is mostly settled against one record; links are made once, among the values of what is left, and
    settled records leave the list. A batch whose links would be many (estimated from a sample of its values) is taken in smaller
    steps. Values that many records hold are one value: pairs of records are never listed.
    """
    size = first_batch or FIRST_BATCH
    least = min(size, SAMPLE)
    named = ordering.numbered(records.select(key, *vids), key, into="_rank")
    slots = [F.struct(F.lit(i).alias("layer"), F.col(v).alias("vid")) for i, v in enumerate(vids)]
    holders = cut_lineage(named.select("_rank", F.explode(F.array(*slots)).alias("_s")).select("_rank", "_s.layer", "_s.vid").filter("vid is not null"))

    def near(left: DataFrame, right: DataFrame | None = None) -> DataFrame:
        """(layer, a, b) over the layers, for tables of (layer, vid)."""
        found = left.sparkSession.createDataFrame([], "layer int, a string, b string")
        for i, layer in enumerate(layers):
            if layer.near:
                of = lambda t: layer.values.join(t.filter(F.col("layer") == i).select("vid"), "vid", "left_semi")
                found = found.unionByName(layer.near(of(left), of(right) if right is not None else None).select(F.lit(i).alias("layer"), "a", "b"))
        return found

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        """(a, b): values of ``left`` that equal or match values of ``right``."""
        equal = left.join(right, ["layer", "vid"], "left_semi").select("layer", F.col("vid").alias("a"), F.col("vid").alias("b"))
        return cut_lineage(near(left, right).unionByName(equal))

    total, low, step = holders.agg(F.max("_rank")).first()[0], 0, size
    originals, pairs = None, []
    while total is not None and low <= total:
        batch = holders.filter((F.col("_rank") >= low) & (F.col("_rank") < low + step))
        values = batch.select("layer", "vid").distinct()
        open_ = batch
        if originals is not None:
            known = originals.select("layer", "vid").distinct()
            hits = met(values, known)
            pairs.append(hits)
            settled = batch.join(hits.select("layer", F.col("a").alias("vid")).distinct(), ["layer", "vid"], "left_semi").select("_rank").distinct()
            open_ = cut_lineage(batch.join(settled, "_rank", "left_anti"))
        if step > least and _dense(open_, near, least):
            pairs, step = pairs[:-1] if originals is not None else pairs, max(least, step // GROWTH)
            continue
        links = near(open_.select("layer", "vid").distinct())
        links = cut_lineage(links.unionByName(links.select("layer", F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
        found = open_.join(_leaders(open_, links), "_rank", "left_semi")
        pairs.append(links.join(found.select("layer", F.col("vid").alias("b")).distinct(), ["layer", "b"], "left_semi").select("layer", "a", "b"))
        if originals is not None and len(layers) > 1:
            # A record that an earlier batch settled may match an original of its own batch in a layer that comes first.
            pairs.append(met(values, found.select("layer", "vid").distinct()))
        originals = cut_lineage(found if originals is None else originals.unionByName(found))
        low, step = low + step, (low + step) * (GROWTH - 1)
    if originals is None:
        nothing = {"original": F.lit(None).cast(records.schema[key].dataType), "layer": F.lit(None).cast("int")}
        return records.select(key).withColumns(nothing)

    lead = originals.groupBy("layer", "vid").agg(F.min("_rank").alias("_lead"))
    matched = lead.select("layer", "vid", F.col("vid").alias("b"))
    for p in pairs:
        matched = matched.unionByName(p.select("layer", F.col("a").alias("vid"), "b"))
    offers = matched.join(lead.withColumnRenamed("vid", "b"), ["layer", "b"]).groupBy("layer", "vid").agg(F.min("_lead").alias("_lead"))
    later = holders.join(originals.select("_rank").distinct(), "_rank", "left_anti")
    best = later.join(offers, ["layer", "vid"]).filter("_lead < _rank").groupBy("_rank").agg(F.min(F.struct("layer", "_lead")).alias("_b"))
    names = named.select(F.col("_rank").alias("_lead"), F.col(key).alias("original"))
    rows = named.select(key, "_rank").join(best, "_rank", "left").select(key, "_b.layer", "_b._lead")
    return rows.join(names, "_lead", "left").select(key, "original", "layer")


def _dense(holders: DataFrame, near: Callable, sample_size: int) -> bool:
    """Whether linking the values would make more than ``DENSE`` links per value: counted among about ``sample_size`` of them, scaled up."""
    values = holders.select("layer", "vid").distinct()
    count = values.count()
    part = max(1, count // sample_size)
    if part == 1:
        return False
    sample = values.filter(F.pmod(F.xxhash64("vid"), F.lit(part)) == 0)
    return near(sample).count() * part * part > DENSE * count


def _leaders(holders: DataFrame, links: DataFrame) -> DataFrame:
    """(_rank) of the records that no earlier leader matches, by value or by link; links are symmetric."""
    several = holders.groupBy("layer", "vid").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("layer", "vid")
    busy = cut_lineage(several.unionByName(links.select("layer", F.col("a").alias("vid"))).distinct())
    open_ = cut_lineage(holders.join(busy, ["layer", "vid"], "left_semi"))
    leaders = holders.select("_rank").distinct().join(open_.select("_rank").distinct(), "_rank", "left_anti")
    while (left := open_.count()) and left + links.count() > TAIL:
        # The earliest open record at each value and at its linked values: who is earliest everywhere leads.
        lowest = open_.groupBy("layer", "vid").agg(F.min("_rank").alias("_low"))
        around = links.join(lowest.withColumnRenamed("vid", "b"), ["layer", "b"]).select("layer", F.col("a").alias("vid"), "_low")
        bound = lowest.unionByName(around).groupBy("layer", "vid").agg(F.min("_low").alias("_low"))
        mine = open_.join(bound, ["layer", "vid"]).groupBy("_rank").agg(F.min("_low").alias("_low")).filter("_low = _rank")
        lead = cut_lineage(mine.select("_rank"))
        held = open_.join(lead, "_rank", "left_semi").select("layer", "vid")
        closed = held.unionByName(links.join(held.withColumnRenamed("vid", "b"), ["layer", "b"], "left_semi").select("layer", F.col("a").alias("vid"))).distinct()
        settled = open_.join(closed, ["layer", "vid"], "left_semi").select("_rank").distinct()
        open_ = cut_lineage(open_.join(settled, "_rank", "left_anti"))
        links = cut_lineage(links.join(open_.select("layer", F.col("vid").alias("a")).distinct(), ["layer", "a"], "left_semi"))
        leaders = leaders.unionByName(lead)
    return cut_lineage(leaders.unionByName(_in_order(open_, links)) if left else leaders)


def _in_order(open_: DataFrame, links: DataFrame) -> DataFrame:
    """``_leaders`` of at most ``TAIL`` rows, one record after the other in one task."""
    rows = open_.select("_rank", "layer", F.col("vid").alias("a"), F.lit(None).cast("string").alias("b"))
    rows = rows.unionByName(links.select(F.lit(None).cast("long").alias("_rank"), "layer", "a", "b"))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, linked = defaultdict(list), defaultdict(list)
        for batch in batches:
            for rank, layer, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                if rank is None:
                    linked[layer, a].append((layer, b))
                else:
                    held[rank].append((layer, a))
        closed, leaders = set(), []
        for rank in sorted(held):
            if closed.isdisjoint(held[rank]):
                leaders.append(rank)
                for value in held[rank]:
                    closed.add(value)
                    closed.update(linked[value])
        yield pa.RecordBatch.from_arrays([pa.array(leaders, pa.int64())], ["_rank"])

    return rows.repartition(1).mapInArrow(settle, "_rank long")


# ---------------------------------------------------------------- layers


def _vid(value: Column) -> Column:
    return F.md5(value.cast("string"))


def _title_sets(df: DataFrame, title: str, stopwords: list[str]) -> DataFrame:
    tokens = F.array_sort(F.array_distinct(tx.title_tokens(F.col(title), stopwords)))
    with_tokens = df.withColumn("_tokens", tokens)
    return with_tokens.withColumn("_title", F.when(F.size("_tokens") > 0, _vid(F.array_join("_tokens", " "))))


def title_layer(rows: DataFrame, threshold: float) -> Layer:
    """Titles match by Jaccard of their tokens; ``rows`` come from ``_title_sets``."""
    distinct = rows.filter("_title is not null").groupBy(F.col("_title").alias("vid")).agg(F.first("_tokens").alias("tokens"))
    values = cut_lineage(rarest_first(distinct, "vid", "tokens"))
    return Layer(values, lambda left, right: similar_sets(left, right, threshold))


def content_layer(hashed: DataFrame, distance: int) -> Layer:
    """Fingerprints match within a Hamming distance; ``hashed`` has (_content, simhash)."""
    if distance > SIMHASH_DISTANCE:
        raise ValueError(f"the buckets prove completeness only up to distance {SIMHASH_DISTANCE}")
    values = cut_lineage(hashed.filter("_content is not null").select(F.col("_content").alias("vid"), "simhash").distinct())

    def near(left: DataFrame, right: DataFrame | None) -> DataFrame:
        side = lambda t, tag: t.select(F.col("vid").alias(tag), F.col("simhash").alias(f"_s{tag}"), F.explode(simhash_buckets(F.col("simhash"))).alias("_bucket"))
        both = side(left, "a").join(side(left if right is None else right, "b"), "_bucket")
        apart = (F.col("a") < F.col("b")) if right is None else (F.col("a") != F.col("b"))
        return both.filter(apart & (hamming(F.col("_sa"), F.col("_sb")) <= distance)).select("a", "b").distinct()

    return Layer(values, near)


def title_originals(
    df: DataFrame, key: str, title: str, threshold: float = 0.8, stopwords: list[str] = catalog.TITLE_STOPWORDS
) -> DataFrame:
    """Original of every title with tokens, by Jaccard of its tokens; no pair at the threshold is missed."""
    rows = cut_lineage(_title_sets(df.select(key, title), title, stopwords).filter("_title is not null").select(key, "_tokens", "_title"))
    found = first_come(rows, key, ["_title"], [title_layer(rows, threshold)])
    return found.select(key, "original", F.col("layer").isNotNull().alias("is_duplicate"))


def content_originals(df: DataFrame, key: str, text: str, distance: int = 4, window: int | None = None) -> DataFrame:
    """Original of every text by Hamming distance of its SimHash."""
    rows = cut_lineage(simhash(df, key, text, window).withColumn("_content", F.hex("simhash")))
    found = first_come(rows, key, ["_content"], [content_layer(rows, distance)])
    return found.select(key, "original", F.col("layer").isNotNull().alias("is_duplicate"))


LAYERS = ("url", "title", "content")


def layered_originals(
    df: DataFrame,
    key: str,
    url: str,
    title: str,
    text: str,
    threshold: float = 0.8,
    distance: int = 4,
    window: int | None = None,
    stopwords: list[str] = catalog.TITLE_STOPWORDS,
) -> DataFrame:
    """URL → title → content decision. Only originals are remembered, so a chain of near copies may
    hold several originals. A URL hit names no original, as a seen-set stores none."""
    hashed = simhash(df.filter(F.trim(text) != ""), key, text, window).withColumn("_content", F.hex("simhash"))
    base = _title_sets(df.select(key, url, title), title, stopwords).withColumn("_link", url_key(F.col(url)))
    rows = cut_lineage(base.select(key, "_link", "_tokens", "_title").join(hashed, key, "left"))
    layers = [Layer(rows), title_layer(rows, threshold), content_layer(rows, distance)]
    found = first_come(rows, key, ["_link", "_title", "_content"], layers)
    layer = F.try_element_at(F.array(*[F.lit(n) for n in LAYERS]), F.col("layer") + 1)
    return found.select(
        key,
        F.col("layer").isNotNull().alias("is_duplicate"),
        layer.alias("layer"),
        F.when(F.col("layer") > 0, F.col("original")).alias("original"),
    )
