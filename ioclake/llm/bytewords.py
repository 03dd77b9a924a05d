"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z.
Every word gets a 64-bit hash of its lower-cased bytes (a polynomial over a
random byte table, then mixed), read off prefix sums, so no Python object is
made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes handled at once; a longer text is one piece of its own
PIECE = 1 << 18

_RADIX = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_RADIX, -1, 2**64)
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
S31, S29 = np.uint64(31), np.uint64(29)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)[LOWER]
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        for key, base in (("up", _RADIX), ("down", _INVERSE)):
            p = np.full(n + 1, base, np.uint64)
            p[0] = 1
            _POWERS[key] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> S31)) * MIX1
    h = (h ^ (h >> S29)) * MIX2
    return h ^ (h >> S31)


@dataclass
class Words:
    """Words of the texts ``first .. first + rows - 1`` of a batch: byte
    spans in ``data``, hashes, and per text the ranges of its words and bytes."""

    first: int
    rows: int
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bound: np.ndarray
    offs: np.ndarray

    def strings(self, which: np.ndarray) -> pa.Array:
        """The lower-cased bytes of the words ``which`` as a binary array."""
        size = (self.end - self.start)[which]
        offs = np.zeros(len(which) + 1, np.int32)
        np.cumsum(size, out=offs[1:])
        at = np.repeat(self.start[which] - offs[:-1], size) + np.arange(offs[-1])
        return pa.Array.from_buffers(pa.binary(), len(which), [
            None, pa.py_buffer(offs), pa.py_buffer(LOWER[self.data[at]])])


def pieces(texts: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, offsets) of runs of whole texts of about
    ``limit`` bytes; a null text is empty."""
    texts = pc.fill_null(texts.cast(pa.binary()), b"")
    if not len(texts):
        return
    _, offs, data = texts.buffers()
    offs = np.frombuffer(offs, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield at, end - at, data[offs[at]:offs[end]], offs[at:end + 1] - offs[at]
        at = end


def words(texts: pa.Array, limit: int = PIECE) -> Iterator[Words]:
    for first, rows, data, offs in pieces(texts, limit):
        n = len(data)
        solid = np.empty(n + 1, bool)
        solid[:n] = ~SPACE[data]
        solid[n] = False
        begin, stop = solid[:n].copy(), solid[:n].copy()
        begin[1:] &= ~solid[:n - 1]
        stop &= ~solid[1:]
        inner = offs[1:-1]
        inner = inner[(inner > 0) & (inner < n)]
        begin[inner] = solid[inner]
        stop[inner - 1] = solid[inner - 1]
        start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        up, down = _powers(max(n, PIECE))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUE[data] * up[:n], out=total[1:])
        h = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
        yield Words(first, rows, data, start, end, h, np.searchsorted(start, offs), offs)
