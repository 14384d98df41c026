"""64-bit hashes of the words of many texts at once, and of word n-grams.

A word's hash is a polynomial in its bytes, taken from running sums over a whole column, so
no word becomes a Python object. Words are what lies between runs of ASCII white
space, with A-Z lower-cased.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_FACTOR = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_BYTES = np.random.Generator(np.random.Philox(key=[77, 1])).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTES[ord("A"):ord("Z") + 1] = _BYTES[ord("a"):ord("z") + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPAN_BITS = 18  # bytes whose running sums are held at a time


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    up, down = np.empty(n, np.uint64), np.empty(n, np.uint64)
    up[0] = down[0] = 1
    up[1:], down[1:] = np.uint64(_FACTOR), np.uint64(_INVERSE)
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _polynomials(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The polynomial of each word's bytes; works through the words span by span."""
    out = np.empty(len(first), np.uint64)
    a = 0
    while a < len(first):
        # As many words as a span holds, or one longer word.
        b = max(a + 1, int(np.searchsorted(last, first[a] + (1 << _SPAN_BITS))))
        start = first[a]
        span = raw[start:last[b - 1] + 1]
        up, down = _powers(max(_SPAN_BITS, int(len(span) - 1).bit_length()))
        sums = np.zeros(len(span) + 1, np.uint64)
        np.cumsum(_BYTES[span] * up[:len(span)], out=sums[1:])
        left = first[a:b] - start
        out[a:b] = (sums[last[a:b] - start + 1] - sums[left]) * down[left]
        a = b
    return out


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a string column, and the number of words of each text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if ends[-1] == ends[0]:
        return np.zeros(0, np.uint64), np.zeros(len(column), np.int64)
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    in_word = ~_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[ends] = True
    before = np.concatenate([[False], in_word[:-1]]) & ~edge[:-1]
    after = np.concatenate([in_word[1:], [False]]) & ~edge[1:]
    first = np.flatnonzero(in_word & ~before)
    last = np.flatnonzero(in_word & ~after)
    hashes = mix(_polynomials(raw, first, last) + (last - first).astype(np.uint64))
    words = np.searchsorted(first, ends)
    return hashes, np.diff(words)


def windows(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words within a text, and their number by text."""
    n = max(0, len(hashes) - size + 1)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(_FACTOR) + hashes[k:k + n])
    text = np.repeat(np.arange(len(counts)), counts)
    return out[text[:n] == text[size - 1:]], np.maximum(counts - size + 1, 0)
