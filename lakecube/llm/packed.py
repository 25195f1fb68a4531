"""Arrays of unsigned 64-bit numbers as compact bytes: differences, byte planes, leading zero planes left out."""

from __future__ import annotations

import numpy as np


def pack(x: np.ndarray, ascending: bool = False) -> bytes:
    """``ascending`` arrays are stored as differences, others above their minimum."""
    x = np.ascontiguousarray(x, dtype=np.uint64)
    if not len(x):
        return b""
    low = x[0] if ascending else x.min()
    d = np.diff(x, prepend=low) if ascending else x - low
    planes = max(1, (int(d.max()).bit_length() + 7) // 8)
    body = d.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()
    return bytes([planes | (0x80 if ascending else 0)]) + int(low).to_bytes(8, "little") + body


def unpack(b: bytes) -> np.ndarray:
    if not b:
        return np.zeros(0, dtype=np.uint64)
    planes, ascending = b[0] & 0x7F, bool(b[0] & 0x80)
    low = np.uint64(int.from_bytes(b[1:9], "little"))
    raw = np.frombuffer(b, dtype=np.uint8, offset=9).reshape(planes, -1)
    out = np.zeros((raw.shape[1], 8), dtype=np.uint8)
    out[:, :planes] = raw.T
    d = out.reshape(-1).view("<u8")
    return (np.cumsum(d, dtype=np.uint64) if ascending else d) + low
