"""Words, shingles and rolling hashes of whole Arrow text batches, in numpy.

Inside a task a batch of texts is one byte buffer with offsets.  Words are
``[^\\x20\\x09-\\x0D]+`` over bytes; since those blanks are ASCII, byte words and
code-point words are the same.  A string's hash is a polynomial over random
per-byte values modulo 2**64, taken from running sums, then mixed.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
WORD_BASE = np.uint64(0xD6E8FEB86659FD93)
SLICE_BYTES = 2 << 20          # texts hashed together; a longer text is a slice of its own

_powers: dict[str, np.ndarray] = {}


def powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept in the worker and grown when needed."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[name] = np.multiply.accumulate(steps)
    return have[:n]


def tidy(rows: Iterator) -> Iterator:
    """``rows``; at their end the worker gives back what it held, so that later stages start from little."""
    try:
        yield from rows
    finally:
        _powers.clear()
        sys.__dict__.pop("_text_encoders", None)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):       # another C library
            pass


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2] or b"", dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES):
    """Row ranges (a, b) whose texts have about ``size`` bytes together."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def is_blank(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of value(data[j]) * BASE**j for j < i."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers("base", BASE, len(data)), out=out[1:])
    return out


def span_hash(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for arrays of bounds."""
    return mix((h[end] - h[start]) * powers("inverse", INVERSE, len(h))[start])


def words(data: np.ndarray, offsets: np.ndarray):
    """(start, end, document) of every word; ``offsets`` bound the documents within ``data``."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    solid = ~is_blank(data)
    left = np.empty_like(solid)
    left[0] = False
    left[1:] = solid[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    left[inner] = False                       # a document's first byte never continues a word
    starts = np.flatnonzero(solid & ~left)
    right = np.empty_like(solid)
    right[-1] = False
    right[:-1] = solid[1:]
    right[inner[inner > 0] - 1] = False
    ends = np.flatnonzero(solid & ~right) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def window_hash(word: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive word hashes (length n - k + 1)."""
    n = len(word) - k + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for j in range(k):
        out = out * WORD_BASE + word[j:j + len(out)]
    return mix(out)


def shingles(data: np.ndarray, offsets: np.ndarray, k: int, lower: bool = True):
    """(document, hash) of every k-word shingle in order; shorter texts give their whole word sequence.

    Also returns the number of words of each document.
    """
    if lower:
        data = LOWER[data]
    starts, ends, doc = words(data, offsets)
    n_words = np.bincount(doc, minlength=len(offsets) - 1)
    word = span_hash(prefix_hash(data), starts, ends)
    h = window_hash(word, k)
    inside = doc[:len(h)] == doc[k - 1:k - 1 + len(h)] if len(h) else np.zeros(0, bool)
    d, h = doc[:len(h)][inside], h[inside]
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    if len(short):
        first = np.searchsorted(doc, short)
        extra = np.zeros(len(short), dtype=np.uint64)
        for j in range(k - 1):
            at = first + j
            has = j < n_words[short]
            extra = np.where(has, extra * WORD_BASE + word[np.minimum(at, len(word) - 1)], extra)
        extra = mix(extra + n_words[short].astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
        d, h = np.concatenate([d, short]), np.concatenate([h, extra])
        order = np.argsort(d, kind="stable")
        d, h = d[order], h[order]
    return d, h, n_words


def distinct_shingles(data: np.ndarray, offsets: np.ndarray, k: int):
    """As shingles(), without repeats in a document; hashes ascend within a document."""
    d, h, n_words = shingles(data, offsets, k)
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return d[new], h[new], n_words
