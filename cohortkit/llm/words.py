"""Vectorised tokenising of Arrow text columns inside tasks.

A text column is one UTF-8 buffer plus offsets, so words are found by byte
class and hashed for a whole batch at once.  Every non-ASCII byte is above
0x7F, hence byte classes are exact for the two word definitions used here.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

__all__ = ["ALNUM", "NONSPACE", "LOWER", "utf8", "slices", "find_words", "hash_words", "hash_ngrams", "mix", "distinct"]

#: Bytes of a batch that one vectorised step handles (a longer text is a step of its own).
STEP_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Byte classes: letters, digits and all non-ASCII; everything but the six ASCII blanks.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
NONSPACE = np.ones(256, dtype=bool)
NONSPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_Q = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers, by sorting: here much faster than a hash set."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, step: int = STEP_BYTES, rows: int | None = None) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``step`` bytes, at least one row and at
    most ``rows`` rows each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + step, side="right")) - 1)
        j = min(j, i + rows) if rows else j
        yield i, min(j, n)
        i = j


def find_words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (byte positions) and row of every maximal run of ``kind``
    bytes; a run never crosses a row."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = kind[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    apart = ~inside[:-1] | edge[1:n]
    first = inside.copy()
    first[1:] &= apart
    apart = ~inside[1:] | edge[1:n]
    last = inside
    last[:-1] &= apart
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        seq = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        seq[0] = 1
        have = np.cumprod(seq)
        if n <= 2 * STEP_BYTES:
            _powers[name] = have
    return have


def hash_words(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: np.ndarray | None = LOWER) -> np.ndarray:
    """64-bit hash of each byte run (after mapping bytes through ``fold``):
    a polynomial in an odd base, read off one running sum per block."""
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + STEP_BYTES, side="right")))
        a, b = int(start[i]), int(end[j - 1])
        part = data[a:b] if fold is None else fold[data[a:b]]
        run = np.zeros(b - a + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _power("up", _P, b - a)[: b - a], out=run[1:])
        s, e = start[i:j] - a, end[i:j] - a
        out[i:j] = (run[e] - run[s]) * _power("down", _P_INV, b - a)[s] + (e - s).astype(np.uint64) * _Q
        i = j
    return mix(out)


def hash_ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes (``len(words) - n + 1``
    values; the caller masks runs that cross rows)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    acc, w = np.zeros(m, np.uint64), np.uint64(1)
    for k in range(n):
        acc += words[k : k + m] * w
        w = np.uint64(int(w) * int(_Q) & 0xFFFFFFFFFFFFFFFF)
    return mix(acc)
