"""Vectorised text work inside tasks: Arrow string columns as byte buffers,
word spans and 64-bit rolling hashes, with numpy only.

Hashes are polynomials over random byte codes modulo 2**64, taken from one
cumulative sum, so any substring's hash costs two lookups. Byte work goes in
segments of at most ``SEGMENT`` bytes cut between words, which bounds the
memory that a very long text takes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
SEGMENT = 1 << 20
BLOCK = 2 << 20  # text of a block of rows
_BASE = 0x9E3779B97F4A7C15  # odd: has an inverse modulo 2**64
_WORD_BASE = 0xC2B2AE3D27D4EB4F


def _lut(*separators: int) -> np.ndarray:
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


#: Words as maximal runs of bytes other than space, tab, LF, VT, FF, CR.
SPACED = _lut(0x20, *range(0x09, 0x0E))
#: Words as maximal runs of ASCII letters and digits and all non-ASCII bytes.
ALNUM = _lut(*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

CODES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)


@cache
def _powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < 2**bits."""
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        p = np.full(1 << bits, b, U64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(base, max(21, int(n).bit_length()))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads the bits of 64-bit hashes."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (n + 1) of a string column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def to_strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Inverse of ``utf8``."""
    offsets = np.ascontiguousarray(offsets, np.int64)
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def row_blocks(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows of at most ``most`` bytes (a longer row alone)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1
        b = min(n, max(a + 1, b))
        yield a, b
        a = b


def batches(stream: Iterator[pa.RecordBatch], column: str, most: int = BLOCK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Arrow batches cut to blocks of rows of bounded text, with the bytes and
    offsets of ``column``."""
    for batch in stream:
        data, offsets = utf8(batch.column(batch.schema.get_field_index(column)))
        for a, b in row_blocks(offsets, most):
            yield batch.slice(a, b - a), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def _segments(is_word, data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges cut at separators, about SEGMENT long."""
    a, n = 0, len(data)
    while a < n:
        b = min(n, a + SEGMENT)
        while b < n:
            free = np.flatnonzero(~is_word[data[b : b + 65536]])
            if len(free):
                b += int(free[0])
                break
            b = min(n, b + 65536)
        yield a, b
        a = b


class Words:
    """The words of a column: ``starts`` and ``ends`` in bytes, 64-bit
    ``hashes`` (not finalised), and ``rows``: offsets (n + 1) of each row's
    words. With ``prefixes`` also hashes of each word's first so many bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, fold: np.ndarray | None = None, prefixes: tuple[int, ...] = ()):
        starts, ends, hashes, heads = [], [], [], [[] for _ in prefixes]
        edge = np.unique(offsets)
        for a, b in _segments(is_word, data):
            part = data[a:b]
            word = is_word[part]
            cut = np.zeros(b - a + 1, bool)
            cut[0] = cut[-1] = True
            cut[edge[np.searchsorted(edge, a) : np.searchsorted(edge, b, "right")] - a] = True
            # a row that ends inside a segment without a separator starts a new word
            before = np.empty(b - a, bool)
            before[0] = False
            before[1:] = word[:-1]
            s = np.flatnonzero(word & (~before | cut[:-1]))
            after = np.empty(b - a, bool)
            after[-1] = False
            after[:-1] = word[1:]
            e = np.flatnonzero(word & (~after | cut[1:])) + 1
            up, down = powers(_BASE, b - a + 1)
            total = np.empty(b - a + 1, U64)
            total[0] = 0
            np.cumsum(CODES[part if fold is None else fold[part]] * up[: b - a], out=total[1:])
            hashes.append((total[e] - total[s]) * down[s])
            for k, out in zip(prefixes, heads, strict=True):
                out.append((total[np.minimum(s + k, e)] - total[s]) * down[s])
            starts.append(s + a)
            ends.append(e + a)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.starts, self.ends, self.hashes = join(starts, np.int64), join(ends, np.int64), join(hashes, U64)
        self.heads = [join(h, U64) for h in heads]
        self.rows = np.searchsorted(self.starts, offsets)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))


def ngrams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Finalised hashes of all runs of n consecutive words inside one row, and
    the index of the first word of each."""
    total = len(words.hashes)
    counts = np.diff(words.rows)
    room = np.maximum(counts - n + 1, 0)
    first = np.repeat(words.rows[:-1] - np.concatenate(([0], np.cumsum(room)[:-1])), room) + np.arange(room.sum())
    return runs(words.hashes, first, n) if total else np.zeros(0, U64), first


def runs(hashes: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Finalised hash of the n word hashes that begin at each of ``first``.
    Computed in blocks of words, so that powers stay small."""
    out = np.empty(len(first), U64)
    step = 1 << 20
    for a in range(0, len(hashes), step):
        lo, hi = np.searchsorted(first, (a, a + step))
        if lo == hi:
            continue
        part = mix(hashes[a : a + step + n])
        up, down = powers(_WORD_BASE, len(part) + 1)
        total = np.empty(len(part) + 1, U64)
        total[0] = 0
        np.cumsum(part * up[: len(part)], out=total[1:])
        at = first[lo:hi] - a
        out[lo:hi] = mix((total[at + n] - total[at]) * down[at] + U64(n))
    return out
