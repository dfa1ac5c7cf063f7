"""Fill-in-middle transformation on a piece table.

A document is a list of pieces (buffer, start, length) over two immutable buffers: its text and the three sentinels.
Cutting splits a piece, arranging permutes pieces and puts sentinel pieces between them, restoring applies the inverse
permutation to the pieces found in an output. Lengths are bytes of UTF-8; no text is copied until pieces are joined,
and hashes read the pieces one after the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelforge.llm.common import small_batches

TEXT, MARKS = 0, 1
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
#: Order of the text's three parts (0 prefix, 1 middle, 2 suffix) in each form; each part follows its own sentinel.
ORDER = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
#: Place of a part's sentinel in ``SENTINELS``, by part.
SENTINEL_AT = (0, 6, 3)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_STARTS = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point

OUT = (
    "doc_id {key}, n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string, "
    "pieces array<struct<buffer:int,start:long,length:long>>"
)
RESTORED = "doc_id {key}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored string, restored_sha256 string"


@dataclass
class PieceTable:
    """Pieces over the text buffer and the sentinel buffer."""

    text: memoryview
    pieces: list[tuple[int, int, int]] = field(default_factory=list)

    @classmethod
    def whole(cls, data: bytes) -> PieceTable:
        return cls(memoryview(data), [(TEXT, 0, len(data))])

    def cut(self, *places: int) -> PieceTable:
        """Split pieces at ascending byte places of what the table spells; a cut at a border leaves an empty piece there."""
        out, at, places = [], 0, list(places)
        for buffer, start, length in self.pieces:
            end = at + length
            while places and places[0] <= end:
                step = places.pop(0) - at
                out.append((buffer, start, step))
                start, length, at = start + step, length - step, at + step
            out.append((buffer, start, length))
            at = end
        return PieceTable(self.text, out)

    def arranged(self, form: str) -> PieceTable:
        """Prefix, middle and suffix in the form's order, each after its sentinel."""
        out = []
        for part in ORDER[form]:
            out += [(MARKS, SENTINEL_AT[part], 3), self.pieces[part]]
        return PieceTable(self.text, out)

    def views(self) -> Iterator[memoryview]:
        marks = memoryview(SENTINELS)
        for buffer, start, length in self.pieces:
            yield (marks if buffer == MARKS else self.text)[start : start + length]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for view in self.views():
            digest.update(view)
        return digest.hexdigest()

    def bytes(self) -> bytes:
        return b"".join(self.views())


def token_ends(data: bytes) -> np.ndarray:
    """Byte ends of the tokens: white space with the word behind it, and white space that ends the text."""
    space = _SPACE[np.frombuffer(data, np.uint8)]
    if not len(space):
        return np.zeros(0, np.int64)
    last = np.flatnonzero(~space & np.append(space[1:], True)) + 1
    return np.append(last, len(data)) if space[-1] else last


def code_points(data: bytes | memoryview) -> int:
    return int(_STARTS[np.frombuffer(data, np.uint8)].sum())


def draws(key: object, seed: int) -> list[int]:
    """Four 32-bit numbers that the seed and the document's key decide; a null key counts as empty text."""
    shown = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(shown[i : i + 8], 16) for i in range(0, 32, 8)]


def transform(key: object, data: bytes, seed: int = 42, rate: int = 50, spm: int = 80) -> tuple[int, str, PieceTable, PieceTable | None]:
    """(tokens, form, output's pieces, the three parts or None) of one text."""
    ends = token_ends(data)
    n, (h1, h2, h3, h4) = len(ends), draws(key, seed)
    table = PieceTable.whole(data)
    if not data or h3 % 100 >= rate or any(s in data for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", table, None
    places = sorted(0 if (units := h % (n + 1)) == 0 else int(ends[units - 1]) for h in (h1, h2))
    parts = table.cut(*places)
    form = "spm" if h4 % 100 < spm else "psm"
    return n, form, parts.arranged(form), parts


def recovered(output: bytes, form: str) -> PieceTable:
    """The text's pieces in an output: those behind the sentinels, put back by the inverse permutation.

    A transformed text held no sentinel, and sentinels begin with a character that occurs nowhere else in them, so the
    first of each kind is the one that was put in.
    """
    if form == "plain":
        return PieceTable.whole(output)
    order = ORDER[form]
    marks = [output.find(SENTINELS[at : at + 3]) for at in (SENTINEL_AT[part] for part in order)]
    if marks[0] != 0 or not 0 <= marks[0] < marks[1] < marks[2]:
        raise ValueError(f"not an output of form {form}")
    stops = [*marks[1:], len(output)]
    pieces: list[tuple[int, int, int]] = [(TEXT, 0, 0)] * 3
    for part, mark, stop in zip(order, marks, stops):
        pieces[part] = (TEXT, mark + 3, stop - mark - 3)
    return PieceTable(memoryview(output), pieces)


def _encoded(column: pa.Array) -> Iterable[bytes]:
    return (x.as_buffer().to_pybytes() if x.is_valid else b"" for x in column)


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output, output_sha256, pieces), one row per row of ``docs``.

    ``rate`` of 100 documents are transformed, ``spm`` of 100 of these suffix first. Narrow: no row leaves its task.
    Null and empty texts and texts that hold a sentinel stay plain; a null key draws as the empty text; rows with one key
    stay separate rows with the same draws; an empty table gives an empty one; other columns of ``docs`` are not read.
    A text's cut may fall on its ends, so parts may be empty; a batch holds at most ``common.BATCH_BYTES`` or one text.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())])
        for batch in batches:
            keys, rows = batch.column(0), []
            for k, data in zip(keys.to_pylist(), _encoded(batch.column(1))):
                n, form, out, parts = transform(k, data, seed, rate, spm)
                chars = [code_points(v) for v in parts.views()][:2] if parts else [None, None]
                rows.append((n, form, *chars, out.bytes().decode(), out.sha256(), [{"buffer": b, "start": s, "length": x} for b, s, x in out.pieces]))
            n, form, first, middle, output, digest, pieces = zip(*rows) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(first, pa.int64()), pa.array(middle, pa.int64()),
                 pa.array(output, pa.string()), pa.array(digest, pa.string()), pa.array(pieces, pa.list_(piece))],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "pieces"],
            )

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, OUT.format(key=rows.schema["doc_id"].dataType.simpleString()))


def restore(transformed: DataFrame) -> DataFrame:
    """The exact text of every row, from ``output`` and ``form`` alone, with its hash; the other columns pass through.

    A null output or form is an error of the caller: ``fill_in_middle`` writes none.
    """
    small_batches(transformed.sparkSession)
    kept = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tables = [recovered(data, form) for form, data in zip(batch.column(2).to_pylist(), _encoded(batch.column(6)))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:6], pa.array([t.bytes().decode() for t in tables], pa.string()), pa.array([t.sha256() for t in tables], pa.string())],
                [*kept, "restored", "restored_sha256"],
            )

    schema = RESTORED.format(key=transformed.schema["doc_id"].dataType.simpleString())
    return transformed.select(*kept, "output").mapInArrow(run, schema)
