"""Integer arrays as bytes, small enough to shuffle by the million.

The bytes of the values are stored plane by plane (all lowest bytes, then all second ones, and
so on) and compressed; sorted arrays are stored as differences.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

_CODECS: dict[str, object] = {}


def _codec(kind: str):
    if kind not in _CODECS:
        _CODECS[kind] = zstandard.ZstdCompressor(level=1) if kind == "c" else zstandard.ZstdDecompressor()
    return _CODECS[kind]


def pack(x: np.ndarray) -> bytes:
    """Unsigned integers below 2^64, in their order."""
    x = np.ascontiguousarray(x, "<u8")
    width = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    planes = x.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return struct.pack("<QB", len(x), width) + _codec("c").compress(planes)


def unpack(b: bytes) -> np.ndarray:
    n, width = struct.unpack_from("<QB", b)
    out = np.zeros((n, 8), np.uint8)
    if n:
        planes = _codec("d").decompress(b[9:], max_output_size=n * width)
        out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    return out.view("<u8").reshape(n)


def pack_sorted(x: np.ndarray) -> bytes:
    """Unsigned integers in ascending order."""
    x = np.asarray(x, np.uint64)
    return pack(np.diff(x, prepend=np.uint64(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b), dtype=np.uint64)


def pack_bits(x: np.ndarray) -> bytes:
    return struct.pack("<Q", len(x)) + _codec("c").compress(np.packbits(x).tobytes())


def unpack_bits(b: bytes) -> np.ndarray:
    (n,) = struct.unpack_from("<Q", b)
    raw = _codec("d").decompress(b[8:], max_output_size=(n + 7) // 8) if n else b""
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)


def to_signed(x: np.ndarray) -> np.ndarray:
    """Order-keeping map from uint64 to int64."""
    return (x ^ np.uint64(1 << 63)).view(np.int64)


def to_unsigned(x: np.ndarray) -> np.ndarray:
    """Order-keeping map from int64 to uint64."""
    return np.ascontiguousarray(x, np.int64).view(np.uint64) ^ np.uint64(1 << 63)
