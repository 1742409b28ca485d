"""Finite automata over arrays, run by an associative scan: each symbol stands
for a function from state to state, functions compose, and a prefix scan of
compositions gives the state before every position without a loop over them."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Sequence

import numpy as np

_WIDTH = 64  # positions that one lane of the scan composes in turn


class Automaton:
    """``step(state, symbol)`` gives the next state. Every symbol has a second
    form, ``symbol + len(symbols)``, which first returns to ``states[0]``: the
    first symbol of a row."""

    def __init__(self, states: Sequence[Hashable], symbols: Sequence[Hashable], step: Callable[[Hashable, Hashable], Hashable]):
        number = {s: i for i, s in enumerate(states)}
        moves = [tuple(number[step(s, x)] for s in states) for x in symbols]
        moves += [(m[0],) * len(states) for m in moves]
        same = tuple(range(len(states)))
        known = {m: i for i, m in enumerate(dict.fromkeys([same, *moves]))}
        todo = list(known)
        while todo:  # all functions that compositions of symbols reach
            f = todo.pop()
            for g in list(known):
                for h in (tuple(g[x] for x in f), tuple(f[x] for x in g)):
                    if h not in known:
                        known[h] = len(known)
                        todo.append(h)
        self.size = len(known)
        kind = np.uint8 if self.size <= 256 else np.uint16
        self.functions = np.array(list(known), np.uint8)
        self.of_symbol = np.array([known[m] for m in moves], kind)
        self.product = np.array([[known[tuple(g[x] for x in f)] for g in known] for f in known], kind).ravel()
        self.reset = len(symbols)

    def _scan(self, f: np.ndarray) -> np.ndarray:
        """Compositions of all functions up to and with each position."""
        n = len(f)
        if n <= _WIDTH:
            out = f.copy()
            for i in range(1, n):
                out[i] = self.product[int(out[i - 1]) * self.size + int(f[i])]
            return out
        lanes = -(-n // _WIDTH)
        padded = np.zeros(lanes * _WIDTH, f.dtype)  # function 0 is the identity
        padded[:n] = f
        across = np.ascontiguousarray(padded.reshape(lanes, _WIDTH).T)
        for i in range(1, _WIDTH):
            across[i] = self.product[across[i - 1].astype(np.int32) * self.size + across[i]]
        before = np.zeros(lanes, f.dtype)
        before[1:] = self._scan(across[-1])[:-1]
        whole = self.product[before.astype(np.int32)[None, :] * self.size + across]
        return np.ascontiguousarray(whole.T).ravel()[:n]

    def states(self, symbols: np.ndarray) -> np.ndarray:
        """The state after each symbol, from ``states[0]`` at the beginning."""
        return self.functions[:, 0][self._scan(self.of_symbol[symbols])]
