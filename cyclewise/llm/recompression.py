"""Run-length grammars of word sequences by recompression, and longest common extensions on them.

``Grammar`` alternates block compression (a maximal run of one symbol becomes one symbol) and pair compression
(the symbols are dealt into a left and a right half, every left symbol followed by a right one becomes one symbol)
until the longest document is a few symbols.  Both steps look at neighbouring symbols only, so equal passages are
cut alike wherever they stand.  An extension climbs from words to ever longer equal symbols and comes down again at
the first difference: some steps a level, each taken by numpy for all questions at once.

Many documents share one grammar.  They stand behind separators that are all different and never compressed, so
no extension leaves its document.
"""

from __future__ import annotations

import numpy as np

#: The levels end when no document is longer than this many symbols.
TOP_SYMBOLS = 4
#: Ways of dealing the symbols into two halves that are tried for each pair compression.
TRIES = 3


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of the symbols (splitmix64)."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class Grammar:
    """The levels of one sequence of symbols, flat: level after level, each from separator to separator.

    ``symbols`` are word numbers from 0, negative ones are separators; the first and the last must be separators.
    """

    def __init__(self, symbols: np.ndarray):
        text = np.asarray(symbols, np.int64)
        self.n = len(text)
        level, size = text, np.ones(self.n, np.int64)
        self._levels: list[tuple[np.ndarray, np.ndarray]] = [(level, size)]
        starts: list[np.ndarray] = []  # first symbol, one level down, of each symbol from level 1 on
        fresh = int(text.max(initial=0)) + 1
        seed = 0
        while self._longest(level) > TOP_SYMBOLS:
            for cut in (self._blocks(level), self._pairs(level, seed)):
                if cut is None or len(cut) == len(level):
                    continue
                level, size, fresh = self._replace(level, size, cut, fresh)
                self._levels.append((level, size))
                starts.append(cut)
                break
            seed += 1
        self._flatten(starts)

    @staticmethod
    def _longest(level: np.ndarray) -> int:
        return int(np.diff(np.flatnonzero(level < 0)).max(initial=1)) - 1

    @staticmethod
    def _blocks(level: np.ndarray) -> np.ndarray | None:
        """Where the runs of equal symbols start; None if all are single."""
        new = np.r_[True, level[1:] != level[:-1]]
        return None if new.all() else np.flatnonzero(new)

    @staticmethod
    def _pairs(level: np.ndarray, seed: int) -> np.ndarray:
        """Where symbols start after pairing, by the best of some ways to deal the symbols into halves."""
        word = level >= 0
        best = np.zeros(len(level) - 1, bool)
        for k in range(TRIES):
            left = (_mix(level, seed * TRIES + k) & np.uint64(1)).astype(bool)
            for joined in (left[:-1] & ~left[1:], ~left[:-1] & left[1:]):
                joined = joined & word[:-1] & word[1:]
                if np.count_nonzero(joined) > np.count_nonzero(best):
                    best = joined
        return np.flatnonzero(np.r_[True, ~best])

    @staticmethod
    def _replace(level, size, start, fresh):
        """The next level: symbols that start at ``start``, named by what they are made of."""
        count = np.diff(np.r_[start, len(level)])
        first, last = level[start], level[start + count - 1]
        made = count > 1
        # a block is (a, a, how many), a pair (a, b, 2): equal contents, equal names
        parts = np.stack([first[made], last[made], count[made]], axis=1)
        out = first.copy()
        if len(parts):
            order = np.lexsort(parts.T)
            ranked = parts[order]
            new = np.r_[False, (ranked[1:] != ranked[:-1]).any(axis=1)]
            name = np.empty(len(parts), np.int64)
            name[order] = fresh + np.cumsum(new)
            out[made] = name
            fresh = int(name.max()) + 1
        total = np.r_[0, np.cumsum(size)]
        return out, total[start + count] - total[start], fresh

    def _flatten(self, starts: list[np.ndarray]) -> None:
        lens = [len(s) for s, _ in self._levels]
        off = np.r_[0, np.cumsum(lens)]
        n = int(off[-1])
        self.symbol = np.concatenate([s for s, _ in self._levels])
        self.size = np.concatenate([s for _, s in self._levels])
        self.up = np.full(n, -1, np.int64)
        self.first_in = np.zeros(n, bool)
        self.last_in = np.zeros(n, bool)
        self.down_first = np.full(n, -1, np.int64)
        self.down_last = np.full(n, -1, np.int64)
        for k, start in enumerate(starts):
            lo, hi = off[k], off[k + 1]
            end = np.r_[start[1:], lens[k]] - 1
            self.up[lo + start] = 1
            owner = np.cumsum(np.where(self.up[lo:hi] == 1, 1, 0)) - 1
            self.up[lo:hi] = hi + owner
            self.first_in[lo + start] = True
            self.last_in[lo + end] = True
            self.down_first[hi : hi + lens[k + 1]] = lo + start
            self.down_last[hi : hi + lens[k + 1]] = lo + end
        # how many equal symbols of the level follow (with itself) and precede
        new = np.r_[True, self.symbol[1:] != self.symbol[:-1]]
        new[off[:-1]] = True
        at = np.flatnonzero(new)
        run = np.diff(np.r_[at, n])
        within = np.arange(n) - np.repeat(at, run)
        self.ahead = np.repeat(run, run) - within
        self.behind = within + 1
        del self._levels

    def extend(self, i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from ``i`` and ``j`` (included) on are equal, to the right or to the left; ``i`` != ``j``."""
        reach = self.ahead if forward else self.behind
        edge = self.first_in if forward else self.last_in
        down = self.down_first if forward else self.down_last
        sign = 1 if forward else -1
        out = np.zeros(len(i), np.int64)
        live = np.arange(len(i))
        a, b = np.asarray(i, np.int64).copy(), np.asarray(j, np.int64).copy()
        climbing = np.ones(len(i), bool)
        while len(live):
            same = self.symbol[a] == self.symbol[b]
            # equal: pass all equal symbols both sides have, then climb where both sides begin a larger symbol
            step = np.where(same, np.minimum(reach[a], reach[b]), 0)
            out[live] += step * self.size[a]
            na, nb = a + sign * step, b + sign * step
            ua, ub = self.up[na], self.up[nb]
            rise = same & climbing & edge[na] & edge[nb] & (ua >= 0) & (ub >= 0)
            a, b = np.where(rise, ua, na), np.where(rise, ub, nb)
            # different: the difference lies within these symbols
            climbing &= same
            below = np.where(same, 0, down[a])
            a = np.where(same, a, below)
            b = np.where(same, b, down[b])
            going = same | ((a >= 0) & (b >= 0))
            live, a, b, climbing = live[going], a[going], b[going], climbing[going]
        return out
