"""Token ids of text columns with a file of the tokenizers library.

A text is cut where no token can reach across: before a blank that follows
visible text, and between an ASCII letter and a mark. Most pieces repeat, so each worker encodes every distinct piece
once and looks the rest up by a 64-bit hash; the ids of a text are those of its
pieces in order, the same as of the whole text. The store of pieces starts anew
when it holds a stated number of them.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np

from benelake.llm import text

MOST = 2_000_000
BLOCK = 4 << 20  # text that is encoded at once

_WHITE = ~text.SPACED
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), 0x7B, 0x7D, 0x7E]] = True  # not |, which special tokens hold


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte offsets at which pieces begin, the row starts among them."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    cut = data == 0x20
    cut[1:] &= ~_WHITE[data[:-1]]
    # white space beyond ASCII ends in a byte over 0x7F after one of these leads
    high = data >= 0x80
    lead2 = data == 0xC2
    lead3 = (data >= 0xE1) & (data <= 0xE3)
    cut[2:] &= ~(high[1:-1] & lead2[:-2])
    cut[3:] &= ~(high[2:-1] & high[1:-2] & lead3[:-3])
    cut[1:] |= _LETTER[data[:-1]] & _MARK[data[1:]]
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(cut)


def _hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hashes of adjacent pieces that cover the data."""
    out = np.empty(len(starts), text.U64)
    ends = np.append(starts[1:], len(data))
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + text.SEGMENT, "right")))
        base = starts[a]
        part = data[base : ends[b - 1]]
        up, down = text.powers(text._BASE, len(part) + 1)
        total = np.empty(len(part) + 1, text.U64)
        total[0] = 0
        np.cumsum(text.CODES[part] * up[: len(part)], out=total[1:])
        s, e = starts[a:b] - base, ends[a:b] - base
        out[a:b] = text.mix((total[e] - total[s]) * down[s] + (e - s).astype(text.U64) * text.U64(0x2545F4914F6CDD1D))
        a = b
    return out


class Encoder:
    """Ids of texts; one for each worker process and file."""

    _known: dict[str, Encoder] = {}

    @classmethod
    def of(cls, path: str, most: int = MOST) -> Encoder:
        """The worker's encoder for ``path``, storing at most ``most`` pieces."""
        if path not in cls._known:
            cls._known[path] = cls(path)
        cls._known[path].most = most
        return cls._known[path]

    def __init__(self, path: str):
        self.most = MOST
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._clear()

    def _clear(self):
        self.keys = np.zeros(0, text.U64)
        self.slots = np.zeros(0, np.int64)
        self.at = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) and the offsets of each row's; ``end`` is appended
        to every row."""
        starts = _cuts(data, offsets)
        hashes = _hashes(data, starts)
        order = np.argsort(hashes)
        ordered = hashes[order]
        new = np.concatenate((ordered[:1] == ordered[:1], ordered[1:] != ordered[:-1]))
        keys, sample = ordered[new], order[new]
        place = np.searchsorted(self.keys, keys)
        there = np.zeros(len(keys), bool)
        inside = place < len(self.keys)
        there[inside] = self.keys[place[inside]] == keys[inside]
        if not there.all():
            if len(self.keys) + (~there).sum() > self.most:
                self._clear()
                there[:] = False
                place[:] = 0
            miss = np.flatnonzero(~there)
            view, ends = memoryview(np.ascontiguousarray(data)), np.append(starts[1:], len(data))
            pieces = [str(view[a:b], "utf-8") for a, b in zip(starts[sample[miss]].tolist(), ends[sample[miss]].tolist(), strict=True)]
            found = [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            fresh = len(self.at) - 1 + np.arange(len(found))
            self.at = np.concatenate((self.at, self.at[-1] + np.cumsum(sizes)))
            self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))))
            self.keys = np.insert(self.keys, place[miss], keys[miss])
            self.slots = np.insert(self.slots, place[miss], fresh)
            place = np.searchsorted(self.keys, keys)
        slot = np.empty(len(hashes), np.int64)
        slot[order] = self.slots[place][np.cumsum(new) - 1]
        sizes = self.at[slot + 1] - self.at[slot]
        before = np.concatenate(([0], np.cumsum(sizes)))
        rows = before[np.searchsorted(starts, offsets)]
        ids = self.ids[np.repeat(self.at[slot] - before[:-1], sizes) + np.arange(before[-1])]
        if end is None:
            return ids, rows
        n = len(offsets) - 1
        out = np.full(len(ids) + n, end, np.uint32)
        out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(rows))] = ids
        return out, rows + np.arange(n + 1)
