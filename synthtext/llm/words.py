"""Vectorised words of Arrow text batches.

A text column of an Arrow batch is one byte buffer with offsets. The helpers
here find the words of a whole run of texts at once with numpy: a 256-entry
byte table says which bytes are part of a word (and folds A-Z), so every
operator states its own definition of a word and shares the scan. Batches are cut at document ends into
runs of about ``CHUNK`` bytes, so memory does not follow the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply, twice)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit constants from a counter."""
    with np.errstate(over="ignore"):
        i = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(0x10001)
        return mix64(i * _BASE) | np.uint64(1)


def byte_table(separators: bytes, fold: bool = True) -> np.ndarray:
    """A random 64-bit value for each byte, 0 for the separators; A-Z have
    the values of a-z."""
    t = constants(256, 7)
    if fold:
        t[65:91] = t[97:123]
    t[np.frombuffer(separators, np.uint8)] = 0
    return t


@dataclass
class Words:
    """Words of a run of texts; ``row`` counts from the run's first text."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray  # words of text r: bounds[r] .. bounds[r + 1]


def text_buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (64-bit, length rows + 1); a null text is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.string())
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    kind = np.int64 if wide else np.int32
    if len(col) == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    o = np.frombuffer(offs, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[o[0] : o[-1]], o - o[0]


def runs(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``size`` bytes; a longer text is alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def find_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    """All words of the texts ``data[offsets[i]:offsets[i+1]]``.

    A word's hash is a polynomial of its folded bytes (a random value for each byte,
    modulo 2^64), mixed; equal words have equal hashes in every batch.
    """
    n, rows = len(data), len(offsets) - 1
    none = np.zeros(0, np.int64)
    if n == 0:
        return Words(none, none, none, np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64))
    value = table[data]
    inside = value != 0
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    heads = offsets[:-1]
    before[heads[heads < n]] = False
    start = np.flatnonzero(inside & ~before)
    if not len(start):
        return Words(none, none, none, np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    tails = offsets[1:] - 1
    after[tails[(tails >= 0) & (offsets[1:] > heads)]] = False
    end = np.flatnonzero(inside & ~after) + 1
    first = start[0]
    span = np.diff(np.append(start, n))
    at = np.arange(first, n) - np.repeat(start, span)
    with np.errstate(over="ignore"):
        power = np.full(int(span.max()) + 1, _BASE | np.uint64(1), np.uint64)
        power[0] = 1
        power = np.cumprod(power, dtype=np.uint64)
        h = np.add.reduceat(value[first:] * power[at], start - first)
        h = mix64(h)
    bounds = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(rows), np.diff(bounds))
    return Words(row, start, end, h, bounds)


def sequence_hash(h: np.ndarray, width: int, coef: np.ndarray) -> np.ndarray:
    """Hash of every ``width`` consecutive word hashes (length n - width + 1)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        s = h[:n] * coef[0]
        for j in range(1, width):
            s = s + h[j : j + n] * coef[j]
        return mix64(s)


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 as Spark's bigint."""
    return x.view(np.int64)
