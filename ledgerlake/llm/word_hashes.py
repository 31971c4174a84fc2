"""Words of texts as 64-bit hashes, cut and hashed by whole arrays: no Python object for a word.

A word's hash is a polynomial of its lower-cased bytes, taken from running sums over the text (arithmetic modulo 2^64, in
which the odd base has an inverse), then mixed. Equal words have equal hashes wherever they stand."""

from __future__ import annotations

import numpy as np

from ledgerlake.llm.text import mix

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    """1, base, base^2 and so on, kept for the next text."""
    if name not in _powers or len(_powers[name]) < n:
        factors = np.full(max(n, 1 << 16), base, np.uint64)
        factors[0] = 1
        _powers[name] = np.cumprod(factors, dtype=np.uint64)
    out = _powers[name][:n]
    if len(_powers[name]) > 1 << 22:  # of a very long text: not kept
        del _powers[name]
    return out


class HashedWords:
    """`hashes` of all words, one text after the other, and `offs`, the word with which each text begins. With `signs`
    (bytes), these are taken off the ends of words, and words of signs alone are left out."""

    def __init__(self, texts: list[bytes], signs: bytes = b""):
        data = np.frombuffer(b" ".join(texts).lower() + b" ", np.uint8)
        space = _SPACE[data]
        core = ~space
        if signs:
            table = np.zeros(256, dtype=bool)
            table[list(signs)] = True
            core &= ~table[data]
        edge = np.flatnonzero(np.diff(space, prepend=True))
        first, past = edge[::2], edge[1::2]  # of words: where spaces end and begin
        if signs:
            place = np.flatnonzero(core)
            before = np.concatenate([[0], np.cumsum(core, dtype=np.int64)])
            low, high = before[first], before[past]
            some = high > low
            first, past = place[low[some]], place[high[some] - 1] + 1
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, len(data)), out=total[1:])
        self.hashes = mix((total[past] - total[first]) * _power("down", _INVERSE, len(data))[first])
        ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
        self.offs = np.concatenate([[0], np.searchsorted(first, ends)]).astype(np.int64)

    def docs(self) -> np.ndarray:
        """The text's index of every word."""
        return np.repeat(np.arange(len(self.offs) - 1), np.diff(self.offs))
