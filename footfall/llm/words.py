"""Words of Arrow text columns as numpy arrays, with rolling hashes.

A word is a run of bytes that are not ASCII white space or control characters.
All functions work on a whole batch at once; no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Most bytes of text worked on at once; a longer text is a piece of its own.
PIECE_BYTES = 2 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = {True: np.ones(1, _U), False: np.ones(1, _U)}

SPACE = np.zeros(256, bool)
SPACE[:33] = True
SPACE[127] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _power_table(inverse: bool, n: int) -> np.ndarray:
    """The first ``n`` powers of the base, or of its inverse, modulo 2^64."""
    have = _powers[inverse]
    step = _INVERSE if inverse else _BASE
    while len(have) < n:
        top = have[-1:] * step
        have = np.concatenate([have, have * top])
    _powers[inverse] = have
    return have[:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A fixed scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = x + _U((int(seed) * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@dataclass
class Words:
    """The words of some texts. ``row`` is the text of each word; bounds are bytes within the piece."""

    data: np.ndarray  # bytes of the texts, one after another
    bounds: np.ndarray  # where each text starts, and the end of the last
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    def first(self) -> np.ndarray:
        """Index of the first word of each text, and the number of words at last."""
        return np.searchsorted(self.row, np.arange(len(self.bounds)))

    def hashes(self, seed: int = 0, lower: bool = True) -> np.ndarray:
        """A 64-bit hash of every word."""
        data = (LOWER[self.data] if lower else self.data).astype(_U) + _U(1)
        up, down = _power_table(False, len(data)), _power_table(True, len(data) + 1)
        total = np.zeros(len(data) + 1, _U)
        np.cumsum(mix(data, seed + 1) * up, out=total[1:])
        return mix((total[self.end] - total[self.start]) * down[self.start] + (self.end - self.start).astype(_U), seed)


def split_words(data: np.ndarray, bounds: np.ndarray) -> Words:
    """Words of the texts that lie between ``bounds`` in ``data``."""
    inside = ~SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    edges = bounds[bounds < len(data)]
    before[edges] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, bounds, np.searchsorted(bounds, start, side="right") - 1, start, end)


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive word hashes, by its first word (the last n-1 are cut off)."""
    if len(hashes) < n:
        return np.zeros(0, _U)
    up, down = _power_table(False, len(hashes)), _power_table(True, len(hashes))
    total = np.zeros(len(hashes) + 1, _U)
    np.cumsum(hashes * up, out=total[1:])
    return mix((total[n:] - total[:-n]) * down[: len(hashes) - n + 1], n)


def stretches(hashes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hash of the words from ``low`` up to ``high`` of each stretch, as ``runs`` gives it; none is empty."""
    up, down = _power_table(False, len(hashes)), _power_table(True, len(hashes))
    total = np.zeros(len(hashes) + 1, _U)
    np.cumsum(hashes * up, out=total[1:])
    # The length is the seed of ``mix`` in ``runs``.
    return mix((total[high] - total[low]) * down[low] + (high - low).astype(_U) * _BASE)


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(from row, to row, bytes, bounds)`` of a text column; null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, values = texts.buffers()[:3]
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    if texts.null_count:  # a null may still span bytes
        filled = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
        yield from pieces(filled, limit)
        return
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + limit, side="right")) - 1)
        yield low, high, data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low]
        low = high


def char_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points before each byte position (continuation bytes of UTF-8 do not count)."""
    seen = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=seen[1:])
    return seen[at]
