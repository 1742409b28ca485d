"""Compact binary columns for shuffles: integer arrays as zstd-compressed byte
planes, sorted arrays as differences first."""

from __future__ import annotations

import struct

import numpy as np
import zstandard


def pack(values: np.ndarray, ordered: bool = False) -> bytes:
    """Bytes for an integer array. ``ordered``: it is sorted ascending."""
    values = np.ascontiguousarray(values)
    if ordered and len(values):
        values = np.diff(values, prepend=values[:1] - values[:1])
    kind = values.dtype.str.encode()
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T if len(values) else np.zeros(0, np.uint8)
    body = zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())
    return struct.pack("<3sBI", kind, ordered, len(values)) + body


def unpack(blob: bytes) -> np.ndarray:
    kind, ordered, n = struct.unpack_from("<3sBI", blob)
    dtype = np.dtype(kind.decode())
    if not n:
        return np.zeros(0, dtype)
    raw = zstandard.ZstdDecompressor().decompress(blob[8:], max_output_size=n * dtype.itemsize)
    values = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(dtype.itemsize, n).T).view(dtype).ravel()
    return np.cumsum(values, dtype=dtype) if ordered else values
