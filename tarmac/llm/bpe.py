"""Byte-level BPE by way of a sentencepiece model written straight from the vocabulary.

Each rank is one piece: its bytes spelt with printable stand-in letters, scored by the negative
rank, so that the best-scored merge is the lowest rank. The normaliser is the identity. A match
of the split pattern is spelt in the same letters and encoded on its own; decoding looks the
ids' bytes up again. A match that is a piece as a whole is that piece, whatever its merges.

Nulls and edge cases: a null or empty text has no ids, and the digests are those of no bytes;
rows are neither moved nor dropped, so repeated rows and null ids pass through.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame

from tarmac.llm.common import annotate

MATCHES_CACHED = 500_000
MATCHES_AT_ONCE = 100_000
NORMAL, UNKNOWN, BPE_MODEL = 1, 2, 2

_LOADED: dict[tuple[str, str], "Codec"] = {}


def stand_ins() -> list[str]:
    """A printable letter for each byte: itself where it is printable, else one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protocol-buffer field: bytes, a number, or a 32-bit float."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def model(pieces: Sequence[bytes]) -> bytes:
    """A serialised sentencepiece model whose id n is ``pieces[n]``; the unknown piece comes last."""
    letters = stand_ins()
    out = []
    for rank, piece in enumerate(pieces):
        spelt = "".join(letters[b] for b in piece).encode()
        out.append(_field(1, _field(1, spelt) + _field(2, float(-rank)) + _field(3, NORMAL)))
    out.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, UNKNOWN)))
    trainer = _field(3, BPE_MODEL) + _field(4, len(pieces) + 1) + _field(24, 0) + _field(40, len(pieces))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join([*out, _field(2, trainer), _field(3, normaliser)])


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file, in the order of their ranks."""
    with open(path, "rb") as file:
        ranks = {int(n): base64.b64decode(piece) for piece, n in map(bytes.split, file)}
    return [ranks[n] for n in range(len(ranks))]


class Codec:
    """Encodes texts to little-endian 32-bit ids, and ids back to bytes."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex
        import sentencepiece

        self.pieces = read_ranks(path)
        self.whole = {piece: struct.pack("<I", n) for n, piece in enumerate(self.pieces)}
        self.spelling = dict(enumerate(stand_ins()))
        self.find = regex.compile(pattern).finditer
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model(self.pieces))
        self.known: dict[str, bytes] = {}

    def _add(self, new: list[str]) -> None:
        """Encode matches that are not known yet."""
        raw = [m.encode() for m in new]
        for match, piece in zip(new, raw, strict=True):
            if piece in self.whole:
                self.known[match] = self.whole[piece]
        rest = [(m, r) for m, r in zip(new, raw, strict=True) if r not in self.whole]
        spelt = [r.decode("latin-1").translate(self.spelling) for _, r in rest]
        for (match, _), ids in zip(rest, self.processor.encode(spelt, num_threads=1), strict=True):
            self.known[match] = np.asarray(ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        out: list[bytes] = []
        matches: list[str] = []

        def flush() -> None:
            if len(self.known) > MATCHES_CACHED:
                self.known.clear()
            if new := set(matches).difference(self.known):
                self._add(list(new))
            out.append(b"".join(map(self.known.__getitem__, matches)))
            matches.clear()

        for match in self.find(text):
            matches.append(match.group())
            if len(matches) >= MATCHES_AT_ONCE:
                flush()
        flush()
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, made once in a worker."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Codec(path, pattern)
    return _LOADED[path, pattern]


def encode(docs: DataFrame, keep: Sequence[str], path: str, pattern: str, text: str = "text") -> DataFrame:
    """``keep``, and the ``ids`` of every text as little-endian unsigned 32-bit integers (binary)."""

    def make() -> Callable[[list], list]:
        own = codec(path, pattern)
        return lambda texts: [[own.encode(t or "") for t in texts]]

    return annotate(docs, text, keep, "ids binary", make)


def round_trip(docs: DataFrame, keep: Sequence[str], path: str, pattern: str, text: str = "text") -> DataFrame:
    """``keep``, n_tokens, and the digests of the ids and of the bytes that they decode to."""

    def make() -> Callable[[list], list]:
        own = codec(path, pattern)

        def score(texts: list) -> list:
            ids = [own.encode(t or "") for t in texts]
            return [
                [len(i) // 4 for i in ids],
                [hashlib.sha256(i).hexdigest() for i in ids],
                [hashlib.sha256(own.decode(i)).hexdigest() for i in ids],
            ]

        return score

    return annotate(docs, text, keep, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", make)
