"""Adaptive context-mixing range coder for token ids.

Ids are coded in blocks of a fixed number. A block starts from an empty model,
so it can be decoded alone, and has a checksum. Three predictions are kept: of
order 2 (the id that last followed the two ids before), of order 1 (that last
followed the id before), each with a confidence, and of order 0 (the last id
with the same low byte). What comes true is one of four events: order 2 hits,
order 1 hits, order 0 hits (its low byte follows), none does (the id itself
follows). The event's probability mixes three sets of counts: those of order
2's confidence, of order 1's confidence, and of the block. A carry-less range
coder with 64-bit state codes the events and the bits.

All blocks of a group advance in step, one id at a time, so each model update is
a numpy operation over all of them.
"""

from __future__ import annotations

import zlib

import numpy as np

U = np.uint64
BLOCK = 2048  # ids of a block
_ORDER1, _ORDER2 = 10, 11  # bits of a block's prediction tables
_TOP, _BOTTOM = U(1) << U(48), U(1) << U(32)
_GAIN = 8  # what an event adds to its counts; 3 * _GAIN * BLOCK stays below 2**16
_BITS = np.array([0, 0, 8, 16], U)
_LANE = np.array([0, 16, 32, 48], U)  # four 16-bit counts share a word
_STEP = U(_GAIN) << _LANE
_ONES = U(0x0001000100010001)
_MASK = U(0xFFFF)


class _Model:
    """A prediction is stored as (id + 1) * 4 + confidence; 0: none. Ids below
    2**16 take 32 bits each, so that the tables of a group stay near the cores."""

    def __init__(self, n: int, wide: bool):
        self.kind = np.uint64 if wide else np.uint32
        self.one, self.two, self.three = (self.kind(x) for x in (1, 2, 3))
        self.block = np.arange(n)
        self.base1, self.base2, self.base0, self.base4 = (self.block << b for b in (_ORDER1, _ORDER2, 8, 2))
        self.table1, self.table2 = (np.zeros(n << b, self.kind) for b in (_ORDER1, _ORDER2))
        self.table0 = np.zeros(n << 8, self.kind)
        self.counts0, self.counts1, self.counts2 = np.zeros(n, U), np.zeros(4 * n, U), np.zeros(4 * n, U)
        self.last1 = self.last2 = np.zeros(n, np.uint32)

    def predict(self, k: int) -> np.ndarray:
        """Cumulative counts of the four events, for the first k blocks, in
        four lanes of a word; ``p1`` and ``p2`` are the predicted ids plus 1."""
        first = self.last1[:k] * np.uint32(2654435761)
        self.at1 = self.base1[:k] + (first >> np.uint32(32 - _ORDER1))
        self.at2 = self.base2[:k] + ((first + self.last2[:k] * np.uint32(2246822519)) * np.uint32(3266489917) >> np.uint32(32 - _ORDER2))
        self.e1, self.e2 = self.table1.take(self.at1), self.table2.take(self.at2)
        self.c1, self.c2 = self.e1 & self.three, self.e2 & self.three
        self.p1, self.p2 = self.e1 >> self.two, self.e2 >> self.two
        self.row1, self.row2 = self.base4[:k] + self.c1.astype(np.int64), self.base4[:k] + self.c2.astype(np.int64)
        self.n1, self.n2 = self.counts1.take(self.row1), self.counts2.take(self.row2)
        # the product adds the lanes up: no lane reaches 2**16
        return (self.n1 + self.n2 + self.counts0[:k] + _ONES) * _ONES

    def update(self, k: int, ids: np.ndarray, new: np.ndarray, event: np.ndarray):
        """``new``: the ids plus 1, of the tables' kind."""
        step = _STEP.take(event)
        self.counts1[self.row1] = self.n1 + step
        self.counts2[self.row2] = self.n2 + step
        self.counts0[:k] += step
        fresh = (new << self.two) | self.one
        for table, at, e, p, c in ((self.table1, self.at1, self.e1, self.p1, self.c1), (self.table2, self.at2, self.e2, self.p2, self.c2)):
            hit = p == new
            table[at] = np.where(hit, e + (c < self.three), np.where(c > self.one, e - self.one, fresh))
        self.table0[self.base0[:k] + (ids & np.uint32(255))] = new
        self.last2, self.last1 = self.last1[:k], ids


def _order(lengths: np.ndarray) -> np.ndarray:
    """Longest blocks first, so that those still running are a prefix."""
    return np.argsort(-lengths, kind="stable")


def encode(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Ids of each block, its code, and its checksum (of ids and code)."""
    if block * 3 * _GAIN >= 1 << 16:
        raise ValueError(f"blocks of {block} ids are too long")
    n = -(-len(ids) // block)
    lengths = np.full(n, block)
    if n:
        lengths[-1] = len(ids) - block * (n - 1)
    padded = np.zeros(n * block, np.uint32)
    padded[: len(ids)] = ids
    steps = np.ascontiguousarray(padded.reshape(n, block).T)  # only the last block can be short, so order is given
    wide = bool(len(ids)) and int(ids.max()) >= 1 << 16
    model = _Model(n, wide)
    low, span = np.zeros(n, U), np.full(n, ~U(0))
    room = block * (5 if wide else 3) + 8
    out, at = np.zeros((n, room), np.uint16), np.zeros(n, np.int64)
    for t in range(int(lengths.max(initial=0))):
        k = n if t < lengths[-1] else n - 1
        own = steps[t, :k]
        cum = model.predict(k)
        slot = own & np.uint32(255)
        new = own.astype(model.kind, copy=False) + model.one
        miss2, miss1 = model.p2 != new, model.p1 != new
        event = miss2 * (1 + miss1 * (1 + (model.table0.take(model.base0[:k] + slot) != new)))
        lane = _LANE.take(event)
        high, below = (cum >> lane) & _MASK, ((cum << U(16)) >> lane) & _MASK
        part = span[:k] // (cum >> U(48))
        low[:k] += part * below
        bits = _BITS.take(event)
        part *= high - below
        part >>= bits
        span[:k] = part
        low[:k] += part * (own & ((U(1) << bits) - U(1)))
        _flush(low, span, k, out, at)
        if wide:
            span[:k] >>= np.where(event == 3, U(16), U(0))
            low[:k] += span[:k] * np.where(event == 3, own >> np.uint32(16), 0).astype(U)
            _flush(low, span, k, out, at)
        model.update(k, own, new, event)
    for _ in range(4):
        out[np.arange(n), at] = (low >> U(48)).astype(np.uint16)
        at += 1
        low <<= U(16)
    codes = [out[i, : at[i]].tobytes() for i in range(n)]
    sums = np.array([zlib.crc32(c, zlib.crc32(ids[i * block : (i + 1) * block].tobytes())) for i, c in enumerate(codes)], np.uint32)
    return lengths, codes, sums


def _flush(low: np.ndarray, span: np.ndarray, k: int, out: np.ndarray, at: np.ndarray) -> None:
    """Write the settled words of the first k blocks."""
    which = None
    while True:
        lo, sp = (low[:k], span[:k]) if which is None else (low[which], span[which])
        same = (lo ^ (lo + sp)) < _TOP
        ready = same | (sp < _BOTTOM)
        i = np.flatnonzero(ready)
        if not len(i):
            return
        lo, sp, same = lo[i], sp[i], same[i]
        which = i if which is None else which[i]
        sp = np.where(same, sp, (U(0) - lo) & (_BOTTOM - U(1)))
        out[which, at[which]] = (lo >> U(48)).astype(np.uint16)
        at[which] += 1
        low[which] = lo << U(16)
        span[which] = sp << U(16)


def decode(lengths: np.ndarray, codes: list[bytes], sums: np.ndarray, wide: bool = False) -> list[np.ndarray]:
    """The ids of each block; any selection of blocks can be decoded."""
    n = len(lengths)
    order = _order(np.asarray(lengths))
    ran = np.asarray(lengths)[order]
    most = max((len(c) // 2 for c in codes), default=0) + 8
    words = np.zeros((n, most), np.uint64)
    for i, j in enumerate(order):
        own = np.frombuffer(codes[j], np.uint16)
        words[i, : len(own)] = own
    flat, base = words.ravel(), np.arange(n) * most
    at = base + 4
    low, span = np.zeros(n, U), np.full(n, ~U(0))
    code = np.zeros(n, U)
    for i in range(4):
        code = code << U(16) | flat[base + i]
    steps = int(ran[0]) if n else 0
    out = np.zeros((steps, n), np.uint32)
    model = _Model(n, wide)
    running = np.searchsorted(-ran, -np.arange(steps), "left")  # blocks longer than t

    def refill(k: int) -> None:
        which = None
        while True:
            lo, sp = (low[:k], span[:k]) if which is None else (low[which], span[which])
            same = (lo ^ (lo + sp)) < _TOP
            i = np.flatnonzero(same | (sp < _BOTTOM))
            if not len(i):
                return
            lo, sp, same = lo[i], sp[i], same[i]
            which = i if which is None else which[i]
            sp = np.where(same, sp, (U(0) - lo) & (_BOTTOM - U(1)))
            code[which] = code[which] << U(16) | flat[at[which]]
            at[which] += 1
            low[which] = lo << U(16)
            span[which] = sp << U(16)

    for t in range(steps):
        k = int(running[t])
        cum = model.predict(k)
        part = span[:k] // (cum >> U(48))
        value = (code[:k] - low[:k]) // part
        event = (value >= (cum & _MASK)).astype(np.int64) + (value >= ((cum >> U(16)) & _MASK)) + (value >= ((cum >> U(32)) & _MASK))
        lane = _LANE.take(event)
        high, below = (cum >> lane) & _MASK, ((cum << U(16)) >> lane) & _MASK
        low[:k] += part * below
        bits = _BITS.take(event)
        part *= high - below
        part >>= bits
        span[:k] = part
        tail = ((code[:k] - low[:k]) // part) & ((U(1) << bits) - U(1))
        low[:k] += part * tail
        refill(k)
        literal = tail.astype(np.uint32)
        if wide:
            span[:k] >>= np.where(event == 3, U(16), U(0))
            more = np.where(event == 3, (code[:k] - low[:k]) // np.maximum(span[:k], U(1)), 0).astype(U)
            low[:k] += span[:k] * more
            refill(k)
            literal = literal | more.astype(np.uint32) << np.uint32(16)
        order0 = model.table0.take(model.base0[:k] + (tail & U(255)).view(np.int64))
        new = np.where(event == 0, model.p2, np.where(event == 1, model.p1, np.where(event == 2, order0, literal.astype(model.kind, copy=False) + model.one)))
        ids = (new - model.one).astype(np.uint32, copy=False)
        model.update(k, ids, new, event)
        out[t, :k] = ids
    found: list[np.ndarray] = [None] * n
    for i, j in enumerate(order):
        own = np.ascontiguousarray(out[: ran[i], i])
        if zlib.crc32(codes[j], zlib.crc32(own.tobytes())) != sums[j]:
            raise ValueError(f"block {j} is damaged")
        found[j] = own
    return found
