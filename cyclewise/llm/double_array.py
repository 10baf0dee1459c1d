"""Double-array tries: one slot per node, BASE says where its children lie, CHECK whose child a slot is.

The child of slot s by symbol c is slot BASE[s] + c, if CHECK there is s.  Nodes are packed level by level: a
node with one child takes the lowest free slot, one with several the first place where all of them fit.
"""

from __future__ import annotations

import numpy as np

ROOT = 0
#: Free places tried for a node with several children, and slots looked through for them, before they go behind the
#: last used slot.
PLACES, WINDOW = 64, 1024


class DoubleArray:
    """A trie over sequences of symbols (numbers from 0 to ``symbols`` - 1, dense), packed from their levels."""

    def __init__(self, symbols: int):
        self.symbols = symbols
        self.base = np.zeros(1, np.int64)
        self.check = np.array([ROOT], np.int64)  # -1: free; the root is its own parent
        self._low = 1  # no slot below is free
        self._top = 1  # no slot from here on is used

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.r_[self.base, np.zeros(more, np.int64)]
            self.check = np.r_[self.check, np.full(more, -1, np.int64)]

    def _free(self, count: int) -> np.ndarray:
        """The lowest free slots."""
        while True:
            found = np.flatnonzero(self.check[self._low :] < 0)[:count] + self._low
            if len(found) == count:
                return found
            self._grow(2 * len(self.check) + count)

    def insert_level(self, slots: np.ndarray, symbols: np.ndarray) -> None:
        """Gives the nodes in ``slots`` children by ``symbols`` (pairs in any order, repeated or not).

        All children of a node are given in one call.
        """
        pairs = np.unique(slots * self.symbols + symbols)
        owner, symbol = pairs // self.symbols, pairs % self.symbols
        at = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(pairs) else np.empty(0, np.int64)
        many = np.diff(np.r_[at, len(pairs)])
        for k in at[many > 1]:
            hi = np.searchsorted(owner, owner[k], side="right")
            self._place(int(owner[k]), symbol[k:hi])
        one = at[many == 1]
        if len(one):
            spot = self._free(len(one))
            self.base[owner[one]] = spot - symbol[one]
            self.check[spot] = owner[one]
            self._top = max(self._top, int(spot[-1]) + 1)
        taken = np.flatnonzero(self.check[self._low : self._top] < 0)
        self._low = self._low + int(taken[0]) if len(taken) else self._top

    def _place(self, owner: int, symbols: np.ndarray) -> None:
        spread = symbols - symbols[0]
        self._grow(self._low + WINDOW + int(spread[-1]) + 1)
        for f in (np.flatnonzero(self.check[self._low : self._low + WINDOW] < 0)[:PLACES] + self._low).tolist():
            if (self.check[f + spread] < 0).all():
                break
        else:
            f = self._top
            self._grow(f + int(spread[-1]) + 1)
        self.base[owner] = f - symbols[0]
        self.check[f + spread] = owner
        self._top = max(self._top, f + int(spread[-1]) + 1)

    def step(self, slots: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The children of ``slots`` by ``symbols``; -1 where there is none."""
        to = self.base[slots] + symbols
        known = (to > 0) & (to < len(self.check))
        to = np.where(known, to, 0)
        return np.where(known & (self.check[to] == slots), to, -1)

    @classmethod
    def of(cls, levels: list[tuple[np.ndarray, np.ndarray]], count: int, symbols: int) -> DoubleArray:
        """The trie of ``count`` sequences; level d is (sequences longer than d, their symbol there)."""
        trie = cls(symbols)
        at = np.zeros(count, np.int64)
        for who, symbol in levels:
            trie.insert_level(at[who], symbol)
            at[who] = trie.step(at[who], symbol)
        return trie
