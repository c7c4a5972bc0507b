"""Polynomial hashes of byte strings in numpy, modulo 2**64, and text batches as bytes.

A prefix sum holds ``table[byte] * BASE**position``; the hash of any span is one
difference, moved to position 0 by the inverse power. Hashes are mixed at the end, so
that all their bits can be used.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse
_INVERSE = pow(_BASE, -1, 1 << 64)
_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mix_one(x: int) -> int:
    """``mix`` of one number."""
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
    return x ^ (x >> 31)


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and its inverse for i up to n, kept for the next, rounded up."""
    size = 1 << max(16, n.bit_length())
    up, down = _powers(size)
    return up[: n + 1], down[: n + 1]


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def series(base: int) -> np.ndarray:
        out = np.full(size + 1, base, np.uint64)
        out[0] = 1
        return np.cumprod(out)

    return series(_BASE), series(_INVERSE)


class Prefixes:
    """Prefix hashes of a buffer; ``span`` hashes its parts."""

    def __init__(self, data: np.ndarray) -> None:
        up, self._down = powers(len(data))
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_table()[data] * up[: len(data)], out=self._sums[1:])

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._down[start])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Without mixing: equal for equal strings of one length, and cheaper."""
        return (self._sums[end] - self._sums[start]) * self._down[start]


def text_chunks(
    column: pa.Array, limit: int = 4 << 20
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first row, end row, bytes, offsets`` of parts of a text column of about
    ``limit`` bytes, a longer text alone. NULL is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), len(column))
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``text, start, end`` of each word: a run of bytes other than ASCII white space."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~_WHITE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] |= inside[edges]
    closes[edges - 1] |= inside[edges - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return np.searchsorted(offsets, start, side="right") - 1, start, end


def shingles(
    data: np.ndarray, offsets: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """``text, hash`` of every run of ``width`` words; a shorter text is one run."""
    text, start, end = words(data, offsets)
    if not len(text):
        return text, np.zeros(0, np.uint64)
    word = Prefixes(data).span(start, end)
    n = len(word)
    up, _ = powers(width)
    whole = np.zeros(max(0, n - width + 1), np.uint64)
    for k in range(width):
        whole += word[k : n - width + 1 + k] * up[k]
    same = text[: n - width + 1] == text[width - 1 :] if n >= width else np.zeros(0, bool)
    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    count = np.diff(np.r_[first, n])
    short = first[count < width]
    alone = np.zeros(len(short), np.uint64)
    for k in range(width - 1):
        held = k < count[count < width]
        alone[held] += word[short[held] + k] * up[k]
    text = np.r_[text[: len(same)][same], text[short]]
    hashed = np.r_[mix(whole[same]), mix(alone + np.uint64(1))]
    order = np.argsort(text, kind="stable")
    return text[order], hashed[order]
