"""Quality classifier by importance resampling: which documents would a sample of the raw corpus need to look like the target?

Documents are bags of hashed n-grams: words, word pairs, and pairs of word shapes (case, digits, symbols, length, and
whether a word repeats the one before). One generative model is counted from target documents (labelled good), one from the
whole corpus; a document's log weight is the sum of its n-grams' log ratios, taken to a fixed length. Adding Gumbel noise and taking the k largest is a
weighted sample without replacement. k is how many documents weigh no less than labelled good ones do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from panelforge.llm.common import as_texts, small_batches, stored, text_or_empty

WORD_SLOTS, SHAPE_SLOTS = 1 << 14, 1 << 13
SLOTS = WORD_SLOTS + SHAPE_SLOTS
PRIOR = 2.0
#: A longer text weighs what so many of its n-grams weigh on average, so that length alone decides nothing.
SPAN = 150
#: Labelled good documents that are read at most: the first by hash of their key.
LABELLED_ROWS = 5000
#: The threshold lies under all but this share of the labelled good documents.
LOSS = 0.001
#: Gumbel noise lies above this in one of 100,000 draws.
MARGIN = 12.0
SEED = 11
KEEP = 200_000
_PAIR = np.uint64(0x9E3779B97F4A7C15)
SYMBOLS = frozenset("#*$%&|<>{}[]=+~^_@\\/!")


def shape(word: str) -> int:
    """Case, digits, symbols, closing mark and length of a word as a small number."""
    case = 3 if len(word) > 1 and word.isupper() else 1 if word[:1].isupper() else 0
    symbols = min(3, sum(c in SYMBOLS for c in word))
    digits = any(c.isdigit() for c in word)
    letters = any(c.isalpha() for c in word)
    return ((case * 4 + symbols) * 2 + digits) * 2 + letters << 4 | (word[-1:] in ".,;:?") << 3 | min(7, len(word) // 3)


class Features:
    """Slots of a text's n-grams, with the words' hashes and shapes remembered."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def codes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > KEEP:
            known.clear()
        for w in [w for w in words if w not in known]:
            known[w] = zlib.crc32(w) << 16 | shape(w.decode())
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words)).astype(np.uint64)

    def slots(self, text: str) -> np.ndarray:
        codes = self.codes(text.encode().split())
        if not len(codes):
            return np.zeros(0, np.int64)
        word, form = codes >> np.uint64(16), codes & np.uint64(0xFFFF)
        hashed = lambda x, n: ((x * _PAIR >> np.uint64(40)) % np.uint64(n)).astype(np.int64)
        pairs = hashed(word[:-1] * np.uint64(0x100000001B3) + word[1:], WORD_SLOTS)
        same = (word[:-1] == word[1:]).astype(np.uint64)
        forms = hashed((form[:-1] << np.uint64(17)) + (form[1:] << np.uint64(1)) + same, SHAPE_SLOTS)
        return np.concatenate([hashed(word, WORD_SLOTS), pairs, WORD_SLOTS + forms])


def slot_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of every slot over all documents: tasks count, Spark adds, and as many rows as there are slots come back."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(), np.zeros(SLOTS, np.int64)
        for batch in batches:
            found = [features.slots(t) for t in as_texts(batch.column(0))]
            if found:
                total += np.bincount(np.concatenate(found), minlength=SLOTS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["slot", "n"])

    out = np.zeros(SLOTS)
    for slot, n in docs.select(text_or_empty(text).alias("t")).mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n")).collect():
        out[slot] = n
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log ratio of the two models, each kind of n-gram a distribution of its own.

    The target's prior is the raw model, weighing ``PRIOR`` n-grams a slot: what few target documents happen not to say tells little.
    """
    out = np.zeros(SLOTS)
    for part in (slice(0, WORD_SLOTS), slice(WORD_SLOTS, SLOTS)):
        q = raw[part] + 1.0
        q /= q.sum()
        mass = PRIOR * len(q)
        out[part] = np.log((target[part] + mass * q) / (target[part].sum() + mass)) - np.log(q)
    return out


def gumbel(key: object) -> float:
    """Noise that depends on the key alone, so a sample can be drawn again."""
    u = (xxhash.xxh64_intdigest(str(key), SEED) + 0.5) / 2.0**64
    return float(-np.log(-np.log(u)))


def ordered_bits(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles."""
    bits = (np.asarray(x, np.float64) + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def kth_largest(ranks: DataFrame, k: int, column: str = "rank") -> int:
    """The k-th largest of a column of longs, exactly: 16 bits of it at a time, from counts that Spark adds up."""
    low, rest = None, k
    for shift in (48, 32, 16, 0):
        part = F.shiftright(column, shift)
        rows = ranks if low is None else ranks.filter(F.shiftright(column, shift + 16) == low)
        for value, n in sorted(rows.groupBy(part.alias("v")).count().collect(), reverse=True):  # at most 65,536 rows
            if rest <= n:
                low = value
                break
            rest -= n
    return low


def labelled(docs: DataFrame, labels: DataFrame, label: str, value: int, key: str, rows: int = LABELLED_ROWS) -> DataFrame:
    """Up to ``rows`` documents of one label: chosen among the labels, so that only their keys meet the documents."""
    chosen = labels.filter(F.col(label) == value).select(key).distinct().orderBy(F.xxhash64(key), key).limit(rows)
    return docs.join(F.broadcast(chosen), key, "left_semi")  # the limit bounds what is broadcast


def threshold(good: np.ndarray) -> float:
    """Weight below which a document is unlike the target: under nearly all the good, by more than the noise moves a document."""
    return float(np.quantile(good, LOSS)) - MARGIN if len(good) else -np.inf


def weighted(docs: DataFrame, ratio: np.ndarray, key: str = "doc_id", text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """(columns, log_weight, n_grams, gumbel_key, rank) of every whole text; narrow. Texts without words weigh 0."""
    small_batches(docs.sparkSession)
    columns = [key] if columns is None else columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            slots = [features.slots(t) for t in as_texts(batch.column(1))]
            weight = np.array([float(ratio[s].sum()) * min(1.0, SPAN / max(1, len(s))) for s in slots])
            noisy = weight + np.array([gumbel(k) for k in batch.column(0).to_pylist()])
            added = [pa.array(weight), pa.array([len(s) for s in slots], pa.int64()), pa.array(noisy), pa.array(ordered_bits(noisy))]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *added], names=[*columns, "log_weight", "n_grams", "gumbel_key", "rank"])

    rows = docs.select(F.col(key).alias("_key"), text_or_empty(text).alias("_text"), *columns)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return rows.mapInArrow(run, f"{schema}, log_weight double, n_grams long, gumbel_key double, rank long")


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, label: str = "quality", key: str = "doc_id", text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of every document with log_weight, n_grams, gumbel_key, rank and whether it is kept.

    The raw model covers all documents, the target model up to ``LABELLED_ROWS`` labelled 1. ``k`` is calibrated if
    unset. Documents whose key equals the k-th largest are all kept, so repeated rows go the same way. Without good labels,
    everything is kept. Null and empty texts weigh 0, what tells nothing.
    """
    target = stored(labelled(docs, labels, label, 1, key).select(key, text), "target")
    ratio = log_ratio(slot_counts(target, text), slot_counts(docs, text))
    scored = stored(weighted(docs, ratio, key, text, columns), "weights")
    if k is None:
        good = weighted(target, ratio, key, text).select("log_weight").collect()  # LABELLED_ROWS keys at most
        least = threshold(np.array([r[0] for r in good]))
        k = scored.filter(F.col("log_weight") >= float(least)).count() if np.isfinite(least) else scored.count()
    cut = kth_largest(scored, k) if k > 0 else None
    return scored.withColumn("kept", F.lit(False) if cut is None else F.col("rank") >= F.lit(cut))


def keep_sampled(docs: DataFrame, labels: DataFrame, k: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that resampling leaves out, all columns as given, whatever their names."""
    whole = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t"), F.struct(*docs.columns).alias("_row"))
    sampled = resample(whole, labels.withColumnRenamed(key, "_k"), k, key="_k", text="_t", columns=["_row"])
    return sampled.filter("kept").select("_row.*")
