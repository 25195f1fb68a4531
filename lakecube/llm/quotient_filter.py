"""Counting quotient filters of pairs of ids: compact, lossless, mergeable counters.

A pair ``(left, right)`` of ids below ``2**bits`` is permuted by a Feistel
network, which is invertible, so the permuted pair stands for the pair itself.  Its top
``bucket_bits`` are the bucket (a filter covers one bucket), and the other
bits are one number below ``2**64``.  In a filter the upper part of that number, the
quotient, is not stored: slots are in quotient order and a count per quotient
says how many of them it has.  A slot holds the full remainder and the pair's
count.  Nothing is cut off a remainder, so no two pairs ever share a counter.
"""

from __future__ import annotations

import numpy as np

from .packed import pack, unpack
from .words import mix

ROUNDS = tuple(np.uint64(x) for x in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89))


def permute(left: np.ndarray, right: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    a, b = left.astype(np.uint64), right.astype(np.uint64)
    for key in ROUNDS:
        a, b = b, a ^ (mix(b + key) & mask)
    return a, b


def restore(a: np.ndarray, b: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    for key in reversed(ROUNDS):
        a, b = b ^ (mix(a + key) & mask), a
    return a, b


def split(left: np.ndarray, right: np.ndarray, bits: int, bucket_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, rest) of each pair."""
    if not bucket_bits <= bits or 2 * bits - bucket_bits > 64:
        raise OverflowError(f"pairs of {bits}-bit ids need more than {bucket_bits} bucket bits")
    a, b = permute(left, right, bits)
    low = np.uint64(bits - bucket_bits)
    return a >> low, ((a & np.uint64((1 << int(low)) - 1)) << np.uint64(bits)) | b


def join(bucket: int, rest: np.ndarray, bits: int, bucket_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of one bucket."""
    a = (np.uint64(bucket) << np.uint64(bits - bucket_bits)) | (rest >> np.uint64(bits))
    return restore(a, rest & np.uint64((1 << bits) - 1), bits)


def encode(rest: np.ndarray, counts: np.ndarray, width: int) -> tuple[bytes, bytes, bytes, int]:
    """A filter of ascending, distinct ``rest`` numbers of ``width`` bits: (slots per quotient, remainders, counts, quotient bits).

    There is about one quotient per slot.
    """
    q = min(width, max(0, len(rest).bit_length() - 1))
    quotient = (rest >> np.uint64(width - q)).astype(np.int64) if q else np.zeros(len(rest), np.int64)
    runs = np.bincount(quotient, minlength=1 << q).astype(np.uint64)
    remainder = rest & np.uint64((1 << (width - q)) - 1) if width > q else np.zeros(len(rest), np.uint64)
    return pack(runs), pack(remainder), pack(counts.astype(np.uint64)), q


def decode(runs: bytes, remainders: bytes, counts: bytes, q: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(rest, counts) of a filter."""
    n = unpack(runs)
    quotient = np.repeat(np.arange(len(n), dtype=np.uint64), n.astype(np.int64))
    rest = unpack(remainders)
    if q:
        rest = rest | (quotient << np.uint64(width - q))
    return rest, unpack(counts).astype(np.int64)


def merge(filters: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One filter of all the decoded filters' counters."""
    rest = np.concatenate([f[0] for f in filters])
    counts = np.concatenate([f[1] for f in filters])
    order = np.argsort(rest, kind="stable")          # runs of ascending numbers: a merge sort
    rest, counts = rest[order], counts[order]
    new = np.ones(len(rest), bool)
    new[1:] = rest[1:] != rest[:-1]
    at = np.flatnonzero(new)
    return rest[at], np.add.reduceat(counts, at) if len(at) else counts
