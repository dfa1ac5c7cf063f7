"""Quality rules by repetition coverage: characters inside duplicated n-grams and lines, from rolling hashes in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelforge.llm.common import as_texts, small_batches, text_or_empty

SPACES = b"\x09\x0a\x0b\x0c\x0d\x20"
SYMBOL = re.compile(rb"[#*$%&|<>]")
#: Largest share of a text's word characters that duplicated n-grams may cover, by n. Twice the published Gopher limits:
#: a clean text of 70 words that says one line twice reaches 0.145, junk starts above 0.6.
DUPLICATE_SHARE = {5: 0.30, 6: 0.28, 7: 0.26, 8: 0.24, 9: 0.22, 10: 0.20}
DUPLICATE_LINE_SHARE = 0.30
SYMBOLS_PER_WORD = 0.1
_BASE = np.uint64(0x9E3779B97F4A7C15)

OUT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "dup_line_share double, dup_ngram_share double, worst_n int, failed array<string>, kept boolean"
)


def _word_codes(words: list[bytes]) -> np.ndarray:
    """Equal words, equal number, within one text: exact, whatever the hash."""
    of: dict[bytes, int] = {}
    return np.array([of.setdefault(w, len(of) + 1) for w in words], np.uint64)


def rolling(codes: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash (mod 2^64) of every window of n codes, each from the sum before it: h(i, n) = Σ c(i + j)·B^(n-1-j)."""
    out = codes[: len(codes) - n + 1].copy()
    for j in range(1, n):
        out *= _BASE
        out += codes[j : len(codes) - n + 1 + j]
    return out


def _grow(hashes: np.ndarray, codes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n words from those of n − 1."""
    return hashes[: len(codes) - n + 1] * _BASE + codes[n - 1 :]


def _covered(hashes: np.ndarray, n: int, words: int, first_too: bool) -> np.ndarray:
    """Which words lie in a window that occurs more than once (or, without the first, that occurred before)."""
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    if not same.any():
        return np.zeros(words, bool)
    marks = np.zeros(len(hashes), bool)
    marks[order[1:][same]] = True
    if first_too:
        marks[order[:-1][same]] = True
    edge = np.zeros(words + 1, np.int32)
    at = np.flatnonzero(marks)
    edge[at] += 1
    np.subtract.at(edge, at + n, 1)
    return np.cumsum(edge[:-1]) > 0


def measure(text: str, limits: dict[int, float] = DUPLICATE_SHARE) -> dict:
    data = text.encode()
    words = data.split()
    n = len(words)
    out = {"n_words": n, "word_chars": 0, "n_symbols": len(SYMBOL.findall(data)), "n_dup_lines": 0, "n_repeat_words": 0, "dup_line_share": 0.0, "dup_ngram_share": 0.0, "worst_n": 0}
    if not n:
        return out | {"over": False}
    sizes = np.array([len(w) for w in words], np.int64)
    if not data.isascii():
        sizes = np.array([len(w.decode()) for w in words], np.int64)
    chars = out["word_chars"] = int(sizes.sum())
    seen, repeated = set(), 0
    for line in data.split(b"\n"):
        if line.strip(SPACES):
            if line in seen:
                out["n_dup_lines"] += 1
                repeated += sum(len(w.decode()) for w in line.split())
            seen.add(line)
    out["dup_line_share"] = repeated / chars
    codes, over, worst = _word_codes(words), False, -1.0
    longest = max([8, *limits])
    hashes = codes
    for k in range(2, min(longest, n) + 1):
        hashes = _grow(hashes, codes, k)
        if k == 8:
            out["n_repeat_words"] = int(_covered(hashes, 8, n, True).sum())
        if k in limits:
            share = float(sizes[_covered(hashes, k, n, False)].sum()) / chars
            over |= share > limits[k]
            if share - limits[k] > worst:
                worst, out["dup_ngram_share"], out["worst_n"] = share - limits[k], share, k
    return out | {"over": over}


def judge(text: str, limits: dict[int, float] = DUPLICATE_SHARE) -> dict:
    m = measure(text, limits)
    n = m["n_words"]
    rules = {"ngrams": m["over"], "lines": m["dup_line_share"] > DUPLICATE_LINE_SHARE, "symbols": m["n_symbols"] > SYMBOLS_PER_WORD * n}
    m["base_failed"] = n < 20 or 100 * m["n_repeat_words"] > 30 * n
    m["failed"] = [name for name, broken in rules.items() if broken]
    m["kept"] = not m["base_failed"] and not m["failed"]
    return m


def keep_good(docs: DataFrame, limits: dict[int, float] = DUPLICATE_SHARE, text: str = "text") -> DataFrame:
    """``docs`` without the rows that the rules reject, all columns as given; one narrow pass."""
    small_batches(docs.sparkSession)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([judge(t, limits)["kept"] for t in as_texts(batch.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def quality_rules(docs: DataFrame, limits: dict[int, float] = DUPLICATE_SHARE, key: str = "doc_id", text: str = "text", keep: list[str] = ()) -> DataFrame:
    """Measures, base verdict and verdict of every whole text, in one narrow pass.

    Words are runs of anything but ASCII white space. A text fails the base rules under 20 words or when 8-word
    windows found twice hold over 30 % of its words. The method rejects where duplicated n-grams (any n of ``limits``,
    each occurrence after the first) or repeated lines cover too large a share of the word characters, or where symbols
    are more than a tenth of the words. Null and empty texts have no words: measures 0, base failed, not kept.
    Rows repeat as given; ``keep`` names further columns to pass through. Memory is one batch of texts.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("_text"), *keep)
    schema = OUT + "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [judge(t, limits) for t in as_texts(batch.column(1))]
            types = {"base_failed": pa.bool_(), "kept": pa.bool_(), "failed": pa.list_(pa.string()), "worst_n": pa.int32(), "dup_line_share": pa.float64(), "dup_ngram_share": pa.float64()}
            names = [c.split(" ")[0] for c in OUT.split(", ")]
            columns = [batch.column(0)] + [pa.array([m[c] for m in found], types.get(c, pa.int64())) for c in names[1:]]
            yield pa.RecordBatch.from_arrays(columns + batch.columns[2:], names=names + list(keep))

    return rows.mapInArrow(run, schema)
