"""Token ids by the tokenizers library; what lies between white space is encoded once and then looked up."""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

#: Chunks of a worker's young store; when full it becomes the old one, from which chunks in use come back. So the frequent
#: chunks of a corpus stay, memory is bounded (about 200 bytes a chunk, two stores) and answers never change.
KEEP = 500_000
#: Longer chunks (rare junk) are encoded each time.
LONGEST = 64
# Chunks of these characters split into runs of letters, single digits and runs of marks, whatever comes around them.
_PLAIN = re.compile(r"[!-&(-~À-ÖØ-öø-ÿ]+")
_PIECES = re.compile(r"[a-zA-ZÀ-ÖØ-öø-ÿ]+|[0-9]|[^a-zA-Z0-9À-ÖØ-öø-ÿ]+")


def width(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def byte_values() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes for themselves, the others from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Ids(dict):
    """Ids of a chunk as bytes: from the old store, or encoded now."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, chunk: bytes) -> bytes:
        found = self.old.get(chunk)
        if found is None:
            found = self.encode(chunk)
            if len(chunk) > LONGEST:
                return found
        if len(self) >= KEEP:
            self.old = dict(self)
            self.clear()
        self[chunk] = found
        return found


class WordEncoder:
    """Ids of whole texts for the lower-casing vocabulary with word ends.

    Its pre-tokenizer drops white space, no special token holds any, and it normalizes by combining sequence: so a text's ids are
    those of its chunks in order. A plain chunk (Latin letters, digits, marks, no apostrophe) goes piece by piece straight to the model;
    any other goes through the whole tokenizer. Ids are little-endian unsigned integers, 16-bit where the vocabulary allows.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = np.dtype(width(self.tokenizer.get_vocab_size(with_added_tokens=True)))
        self.model = self.tokenizer.model
        self.shown = [c for c, _ in sorted(byte_values().items(), key=lambda x: x[1])]
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.known = _Ids(self._chunk)

    def _piece(self, shown: str) -> bytes:
        return array(self.code, [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _chunk(self, chunk: bytes) -> bytes:
        if chunk.isalpha() and chunk.islower():  # ASCII letters
            return self._piece(chunk.decode())
        if chunk[-1:] in b".,;:!" and len(chunk) > 1 and chunk[:-1].isalpha():
            return self.known[chunk[:-1]] + self.known[chunk[-1:]]
        text = chunk.decode()
        if _PLAIN.fullmatch(text) and b"<|" not in chunk:
            pieces = _PIECES.findall(text.lower())
            if len(pieces) == 1:
                return self._piece("".join([self.shown[b] for b in pieces[0].encode()]))
            return b"".join([self.known[p.encode()] for p in pieces])
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        of = self.known.__getitem__
        # Lowering A-Z first makes fewer chunks; the special tokens are lower case, so a text that may hold some stays as it is.
        return [b"".join(map(of, (data if b"<|" in data else data.lower()).split())) for data in map(str.encode, texts)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
