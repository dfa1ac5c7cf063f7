"""Toxicity by compression distance: windows of a text are compressed with a dictionary of ordinary text and with one that also holds toxic text.

A window that the toxic dictionary makes shorter holds what toxic texts say and ordinary ones do not. Both dictionaries are
trained by zstandard on labelled texts; their contents are used as raw prefixes, the ordinary one in both, so the difference in
length is what the toxic part saves. A window is a word with its borders: longer ones bury a short insult under the
chance matches of their other words (held-out recall falls with longer ones), and as windows repeat, a
worker compresses each distinct one once. A logistic curve over the savings, fitted on labelled texts that the dictionaries
have not seen, calibrates the score.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from panelforge.llm.common import as_texts, small_batches, text_or_empty

#: Labelled texts of each kind that the fit reads at most: the first by hash of their key.
TOXIC_ROWS, ORDINARY_ROWS = 2000, 4000
TOXIC_BYTES, ORDINARY_BYTES = 2048, 4096
#: A byte n-gram goes into the toxic samples if it is in this share of the toxic texts, and so many times as often as in ordinary ones.
GRAM, MIN_SHARE, MIN_TEXTS, MIN_RATIO = 5, 0.01, 4, 3.0
STRETCH = 300  # words of one ordinary sample; a longer text is several
MARKS = b".,;:!?\"'()|"
#: Begins every window and both dictionaries: its match pays the fixed cost of a block, so a second match shows in full.
LEAD = b"~#~#~#~#~#~#"
#: Ends every window: the compressor does not look for matches that begin in the last eight bytes.
TAIL = b"<+=^`{}>"
PARAMETERS = dict(window_log=14, hash_log=12, chain_log=12, search_log=4, min_match=5, strategy=zstandard.STRATEGY_LAZY)
TOP, LEVELS = 3, (2, 4, 6, 8)
FEATURES = TOP + len(LEVELS) + 1
KEEP = 300_000  # savings of windows that a worker remembers


def tokens(text: str) -> list[bytes]:
    return text.encode().lower().split()


def window(word: bytes) -> bytes:
    return b" %b " % word.strip(MARKS)


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Its tables and its reach grow with the dictionary, so that all of a larger one is found."""
    bits = len(content).bit_length()
    sizes = {k: max(PARAMETERS[k], bits + 1) for k in ("window_log", "hash_log", "chain_log")}
    own = zstandard.ZstdCompressionParameters(format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_dict_id=False, write_checksum=False, **PARAMETERS | sizes)
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=own)


def trained(samples: list[bytes], size: int) -> bytes:
    """Content of a trained dictionary; too few samples to train on are a dictionary themselves."""
    if not samples:
        return b" "
    try:
        data = zstandard.train_dictionary(size, samples, k=24, d=6, level=3).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(dict.fromkeys(b" ".join(samples).split()))[:size] or b" "
    return data[data.rfind(b"\x08\x00\x00\x00") + 4 :]  # after the header's last start offset


def without_copies(texts: list[str]) -> list[list[bytes]]:
    """Words of each text, leaving out those that mostly repeat earlier ones: a group of copies counts once."""
    seen, out = set(), []
    for text in texts:
        words = [w.strip(MARKS) for w in tokens(text)]
        own = {hash(tuple(words[i : i + 5])) for i in range(max(1, len(words) - 4))}
        if len(own & seen) <= 0.2 * len(own):
            out.append(words)
        seen |= own
    return out


def grams(words: set[bytes]) -> set[bytes]:
    return {w[i : i + GRAM] for w in map(window, words) for i in range(len(w) - GRAM + 1)}


def fragments(word: bytes, telling: set[bytes]) -> list[bytes]:
    """The stretches of a window that telling n-grams cover."""
    whole = window(word)
    covered = bytearray(len(whole))
    for i in range(len(whole) - GRAM + 1):
        if whole[i : i + GRAM] in telling:
            covered[i : i + GRAM] = b"\1" * GRAM
    out, at = [], 0
    while (lo := covered.find(1, at)) >= 0:
        at = covered.find(0, lo)
        at = len(whole) if at < 0 else at
        out.append(whole[lo:at])
    return out


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """Contents of the two dictionaries: what is over-represented in toxic texts, and ordinary text as it stands."""
    a, b = without_copies(toxic), without_copies(ordinary)
    in_a, in_b = (Counter(g for words in x for g in grams(set(words))) for x in (a, b))
    least = max(MIN_TEXTS, MIN_SHARE * len(a))
    telling = {g for g, c in in_a.items() if c >= least and (c - 2 * c**0.5) / len(a) > MIN_RATIO * (in_b[g] + 1) / (len(b) + 1)}
    found = [[f for w in words for f in fragments(w, telling)] for words in a]
    said = [b"|".join(f) for f in found]
    plain = [b" %b " % b" ".join(words[i : i + STRETCH]) for words in b for i in range(0, len(words), STRETCH)]
    pick = lambda samples: [s for s in samples if len(s) > 8]
    content = trained(pick(said), TOXIC_BYTES)
    # Training cuts segments of fixed length; the fragments that it left incomplete follow, all of them, however many.
    for f, _ in sorted(Counter(f for x in found for f in set(x)).items(), key=lambda x: (-x[1], x[0])):
        if f not in content:
            content = f + content
    return content, trained(pick(plain), ORDINARY_BYTES)


class Scorer:
    def __init__(self, toxic: bytes, ordinary: bytes, weights: list[float] | None = None):
        self.with_toxic, self.without = compressor(LEAD + ordinary + toxic).compress, compressor(LEAD + ordinary).compress
        self.weights = None if weights is None else np.array(weights)
        self.known: dict[bytes, int] = {}

    def saved(self, word: bytes) -> int:
        """Bytes by which the toxic dictionary makes the word's window shorter."""
        found = self.known.get(word)
        if found is None:
            data = LEAD + window(word) + TAIL
            found = len(self.without(data)) - len(self.with_toxic(data))
            if len(self.known) >= KEEP:
                self.known.clear()
            if len(word) <= 64:
                self.known[word] = found
        return found

    def features(self, text: str) -> list[float]:
        """The largest savings, how many windows reach each level, and how many there are, the numbers as logarithms."""
        savings = np.fromiter(map(self.saved, tokens(text)), np.int64)
        top = np.sort(np.r_[savings[savings > 0], [0] * TOP])[::-1][:TOP]
        return [*top.tolist(), *[float(np.log1p((savings >= k).sum())) for k in LEVELS], float(np.log1p(len(savings)))]

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights @ np.array([1.0, *self.features(text)]), -30, 30))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Newton's method; the first column of ``x`` is the constant."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_rows(rows: list[tuple[str, int, bool]]) -> dict:
    """Model from (text, label, whether it calibrates) rows: dictionaries from the one half, the curve from the other."""
    part = lambda label, calibrates: [t for t, y, c in rows if y == label and c == calibrates]
    toxic, ordinary = dictionaries(part(1, False), part(0, False))
    scorer = Scorer(toxic, ordinary)
    held = [(scorer.features(t), y) for t, y, c in rows if c]
    x = np.array([[1.0, *f] for f, _ in held]) if held else np.zeros((0, FEATURES + 1))
    y = np.array([float(y) for _, y in held])
    if len(set(y.tolist())) < 2:  # nothing to tell apart: the share of toxic rows, whatever the text
        share = (sum(r[1] for r in rows) + 0.5) / (len(rows) + 1)
        weights = np.array([np.log(share / (1 - share)), *[0.0] * FEATURES])
    else:
        weights = logistic(x, y)
    return {"toxic": toxic.hex(), "ordinary": ordinary.hex(), "weights": weights.tolist()}


def fit(docs: DataFrame, labels: DataFrame, learns: Column, label: str = "toxic", key: str = "doc_id", text: str = "text") -> dict:
    """A model of a few kilobytes from at most ``TOXIC_ROWS`` and ``ORDINARY_ROWS`` labelled texts where ``learns`` holds.

    The rows are chosen among the labels alone; their texts are joined afterwards and fitted in one task.
    """
    order = F.xxhash64(key)
    usable = labels.filter(learns & F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).alias("_label"))
    pick = lambda value, rows: usable.filter(F.col("_label") == value).orderBy(order, key).limit(rows)
    chosen = pick(1, TOXIC_ROWS).unionByName(pick(0, ORDINARY_ROWS))
    small_batches(docs.sparkSession)
    rows = docs.select(key, text).join(chosen, key).select(text_or_empty(text).alias("t"), F.col("_label").cast("int").alias("y"), (F.pmod(order, F.lit(2)) == 0).alias("c"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
        yield pa.RecordBatch.from_pydict({"model": [json.dumps(fit_rows(sorted(data)))]})

    fitted = rows.repartition(1).mapInArrow(run, "model string").first()
    return json.loads(fitted["model"]) if fitted else fit_rows([])


def score(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every whole text, window by window; null and empty texts have no window and score what no evidence scores."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(bytes.fromhex(model["toxic"]), bytes.fromhex(model["ordinary"]), model["weights"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([scorer.score(t) for t in as_texts(batch.column(1))], pa.float64())], names=[key, "score"])

    return docs.select(key, text_or_empty(text).alias("_text")).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, learns: Column, threshold: float = 0.7, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, predicted) of every row of ``docs``; labels that are null or neither 0 nor 1 are not used."""
    scored = score(docs, fit(docs, labels, learns, key=key, text=text), key, text)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
