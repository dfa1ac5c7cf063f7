"""Byte-level BPE by a distinct-word table: each distinct word is encoded once, ids go back to the texts by position.

Texts are split the way the vocabulary's pre-tokenizer does, so merges never cross a word and a text's ids are those of
its words in order. Decoding joins ids with the id-to-piece table of the vocabulary, whose size is the vocabulary's.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from panelforge.llm import word_blocks
from panelforge.llm.tokens import byte_values

# Fixed value: the published split of this kind of vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"""

# Texts of these characters alone are split by the pattern; all Unicode versions class them alike. Others are split by the library.
SETTLED = r"[^\x00-\u052f\u1e00-\u1eff\u2010-\u205e\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]"


def splitter(vocabulary: str) -> Callable[[], Callable[[str], list[str]]]:
    """Words of a text: a special token of the vocabulary is a word, and what lies between is split by ``SPLIT``."""

    def make() -> Callable[[str], list[str]]:
        with open(vocabulary) as source:
            special = [x["content"] for x in json.load(source)["added_tokens"]]
        pattern, unsettled, library = regex.compile(SPLIT).findall, re.compile(SETTLED).search, []

        def words(text: str) -> list[str]:
            if text.isascii() or not unsettled(text):
                return pattern(text)
            if not library:
                library.append(Tokenizer.from_file(vocabulary).pre_tokenizer)
            return [text[a:b] for _, (a, b) in library[0].pre_tokenize_str(text)]

        if not special:
            return words
        marks = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")

        def split(text: str) -> list[str]:
            if not any(s in text for s in special):
                return words(text)
            return [w for i, part in enumerate(marks.split(text)) for w in ([part] if i % 2 else words(part))]

        return split

    return make


def pieces(vocabulary: str) -> list[bytes]:
    """Bytes of every id: the id-to-piece table. Added tokens stand for their own text."""
    with open(vocabulary) as source:
        content = json.load(source)
    value = byte_values()
    out = [b""] * (1 + max([*content["model"]["vocab"].values(), *(x["id"] for x in content["added_tokens"])]))
    for piece, i in content["model"]["vocab"].items():
        out[i] = bytes(value[c] for c in piece)
    for x in content["added_tokens"]:
        out[x["id"]] = x["content"].encode()
    return out


def _gather(starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, ends) of runs ``starts[i], sizes[i]`` for every i of ``at``, one after the other."""
    n = sizes[at]
    ends = np.r_[0, np.cumsum(n)]
    return np.repeat(starts[at] - ends[:-1], n) + np.arange(ends[-1]), ends


def _word_ids(vocabulary: str):
    def encode(bucket: int, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = _TOKENIZERS.get(vocabulary)
        if tokenizer is None:
            tokenizer = _TOKENIZERS[vocabulary] = Tokenizer.from_file(vocabulary)
            tokenizer.no_truncation()
            tokenizer.no_padding()
        press, known = zstandard.ZstdCompressor(level=3), {}
        for _, block, payload in rows:
            words, (steps,) = word_blocks.unpacked(payload, 1)
            new = [w for w in words if w not in known]
            found = tokenizer.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)
            known.update((w, np.array(x.ids, "<u4").tobytes()) for w, x in zip(new, found))
            ids = [known[w] for w in words]
            answer = np.array([len(words)], "<i8").tobytes() + np.cumsum(steps).astype("<i8").tobytes() + (np.fromiter(map(len, ids), "<i8", len(ids)) // 4).tobytes() + b"".join(ids)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([press.compress(answer)], pa.binary())], names=["block", "payload"])

    return encode


_TOKENIZERS: dict = {}


def _text_ids(folder: str, emit: Callable, names: list[str]):
    def texts(block: int, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        opened = zstandard.ZstdDecompressor()
        places, counts, ids = [], [], []
        for _, payload in rows:
            data = opened.decompress(payload)
            n = int(np.frombuffer(data, "<i8", 1)[0])
            places.append(np.frombuffer(data, "<i8", n, 8))
            counts.append(np.frombuffer(data, "<i8", n, 8 + 8 * n))
            ids.append(np.frombuffer(data, "<u4", offset=8 + 16 * n))
        place, count, flat = np.concatenate(places), np.concatenate(counts), np.concatenate(ids)
        starts, sizes = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        starts[place] = np.cumsum(count) - count
        sizes[place] = count
        for keys, ends, codes in word_blocks.texts_of(folder, block):
            out = []
            for i in range(len(keys)):
                where, _ = _gather(starts, sizes, codes[ends[i] : ends[i + 1]])
                out.append(emit(flat[where]))
            if out:
                yield pa.RecordBatch.from_arrays([keys, *(pa.array(c) for c in zip(*out))], names=names)

    return texts


def encode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>) of every whole text; null and empty texts have no ids; rows repeat as given."""
    name = f"`{key}` {docs.schema[key].dataType.simpleString()}"
    return _encoded(docs, vocabulary, key, text, lambda ids: (ids.astype(np.int32),), [key, "ids"], f"{name}, ids array<int>")


def _encoded(docs, vocabulary, key, text, emit, names, schema) -> DataFrame:
    blocks = word_blocks.write_blocks(docs, splitter(vocabulary), key, text)
    answers = word_blocks.by_bucket(blocks.words, _word_ids(vocabulary), "block long, payload binary")
    return word_blocks.by_block(answers, _text_ids(blocks.folder, emit, names), schema)


def decoder(vocabulary: str) -> Callable[[np.ndarray], str]:
    """Text of a row of ids by the id-to-piece table; bytes that are no UTF-8 become U+FFFD."""
    piece = pieces(vocabulary).__getitem__
    return lambda ids: b"".join(map(piece, ids.tolist())).decode("utf-8", "replace")


def decode(rows: DataFrame, vocabulary: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) of rows of ids, nulls as no ids. The piece table is as large as the vocabulary and read by each worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = decoder(vocabulary)
        for batch in batches:
            found = [text(np.array(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=[key, "text"])

    return rows.select(key, ids).mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): digests of the ids and of the text decoded from them, in one pass over the blocks."""
    pieces_of: list = []

    def digest(ids: np.ndarray) -> tuple[int, str, str]:
        if not pieces_of:
            pieces_of.append(decoder(vocabulary))
        back = pieces_of[0](ids)
        return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()

    name = f"`{key}` {docs.schema[key].dataType.simpleString()}"
    names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
    return _encoded(docs, vocabulary, key, text, digest, names, f"{name}, n_tokens long, ids_sha256 string, decoded_sha256 string")
