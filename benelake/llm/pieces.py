"""A worker's store of encoded pieces: each distinct slice of text is encoded
once, and its ids are found again by a 64-bit hash of its bytes."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np

from benelake.llm import text
from benelake.llm.tokens import _hashes

MOST = 2_000_000
AT_ONCE = 8_192  # pieces encoded at a time


class PieceStore:
    """Ids of slices. ``encode`` takes a list of byte strings and returns a
    list of lists of ids; the store starts anew when it would hold more than
    ``most`` pieces, so its memory is bounded."""

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]], most: int = MOST):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self):
        self.keys = np.zeros(0, text.U64)
        self.slots = np.zeros(0, np.int64)
        self.at = np.zeros(1, np.int64)
        self.known = np.zeros(0, np.int32)

    def ids(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (int32) of the adjacent slices that begin at ``starts`` and cover
        the data, and the offsets of each slice's ids."""
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(1, np.int64)
        keys, sample, back = np.unique(_hashes(data, starts), return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, keys)
        there = np.zeros(len(keys), bool)
        inside = place < len(self.keys)
        there[inside] = self.keys[place[inside]] == keys[inside]
        if not there.all():
            if len(self.keys) + (~there).sum() > self.most:
                self._clear()
                there[:] = False
                place[:] = 0
            self._add(data, starts, keys, sample, place, np.flatnonzero(~there))
            place = np.searchsorted(self.keys, keys)
        slot = self.slots[place][back]
        sizes = self.at[slot + 1] - self.at[slot]
        before = np.concatenate(([0], np.cumsum(sizes)))
        return self.known[np.repeat(self.at[slot] - before[:-1], sizes) + np.arange(before[-1])], before

    def _add(self, data, starts, keys, sample, place, miss):
        view, ends = memoryview(np.ascontiguousarray(data)), np.append(starts[1:], len(data))
        spans = list(zip(starts[sample[miss]].tolist(), ends[sample[miss]].tolist(), strict=True))
        found = []
        for i in range(0, len(spans), AT_ONCE):
            found += self.encode([bytes(view[a:b]) for a, b in spans[i : i + AT_ONCE]])
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        fresh = len(self.at) - 1 + np.arange(len(found))
        self.at = np.concatenate((self.at, self.at[-1] + np.cumsum(sizes)))
        self.known = np.concatenate((self.known, np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))))
        self.keys = np.insert(self.keys, place[miss], keys[miss])
        self.slots = np.insert(self.slots, place[miss], fresh)
