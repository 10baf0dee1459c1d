"""Letter n-grams of many texts at once, as numpy arrays."""

from __future__ import annotations

import functools

import numpy as np

#: Characters of one numpy pass; a longer single text is one pass of its own.
PASS_CHARS = 400_000
_SPACE = 32
_MIX = 0x9E3779B97F4A7C15
_STEP = [np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)]


@functools.lru_cache(maxsize=1)
def folding() -> np.ndarray:
    """Code point -> its lower-case letter, or a blank for anything that is no letter."""
    out = np.full(0x110000, _SPACE, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded characters of all texts with runs of non-letters as one blank and a separator around each text;
    the text each character belongs to; whether a text has a letter."""
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    low = folding()[codes]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    has = np.bincount(owner, weights=low != _SPACE, minlength=len(texts)) > 0
    # a blank before and after each text, so that its first and last words have both ends
    ends = np.cumsum(lengths)
    at = np.concatenate([ends - lengths, ends])
    who = np.concatenate([np.arange(len(texts)), np.arange(len(texts))]).astype(np.int32)
    order = np.lexsort((np.repeat([1, 0], len(texts)), at)) if len(texts) else np.empty(0, np.int64)
    low = np.insert(low, at[order], _SPACE)
    owner = np.insert(owner, at[order], who[order])
    same = np.empty(len(low), dtype=bool)
    if len(low):
        same[0] = False
        same[1:] = (low[1:] == _SPACE) & (low[:-1] == _SPACE) & (owner[1:] == owner[:-1])
    return low[~same], owner[~same], has


def hashes(low: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the n-grams that lie in one text and do not span words, and the text of each."""
    m = len(low) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int32)
    h = np.full(m, n * _MIX % 2**64, dtype=np.uint64)
    ok = owner[: m] == owner[n - 1 :]
    for k in range(n):
        part = low[k : k + m]
        h = (h ^ part) * _STEP[k % 4]
        h ^= h >> np.uint64(29)
        if 0 < k < n - 1:
            ok &= part != _SPACE
    return h[ok], owner[:m][ok]
