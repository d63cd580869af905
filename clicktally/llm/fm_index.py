"""An FM-index over one shard of symbols: suffix array, wavelet matrix, sampled positions.

Defined results: a shard ends with a break; one of breaks alone (null and empty texts) holds no
occurrence; equal stretches (repeated rows) are found at each of their places; a shard is as long as its
longest text, and memory follows it.
"""

from __future__ import annotations

import numpy as np

BREAK = 0


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Exact suffix order by prefix doubling; only suffixes that still tie are sorted again.

    ``text`` ends with a break. Breaks count as different symbols in order of place, so that no
    comparison goes past one.
    """
    n = len(text)
    breaks = text == BREAK
    n_breaks = int(breaks.sum())
    rank = np.where(breaks, np.cumsum(breaks) - 1, n_breaks + text.astype(np.int64))
    following = np.append(rank[1:], 0)
    key = np.where(breaks, rank, rank * (int(rank.max()) + 1) + following)
    order = np.argsort(key, kind="stable")
    slots, key = np.arange(n), key[order]
    members, step = order.copy(), 2
    while len(slots):
        first = np.concatenate([[True], key[1:] != key[:-1]])
        rank[members] = slots[np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))]
        tied = ~(first & np.append(first[1:], True))
        slots, members = slots[tied], members[tied]
        if not len(slots):
            break
        key = rank[members] * n + rank[members + step]
        again = np.argsort(key, kind="stable")
        members, key = members[again], key[again]
        order[slots] = members
        step *= 2
    return order


class FMIndex:
    """Backward search and locate for many patterns at a time. Symbols are 1..sigma, 0 is a break."""

    def __init__(self, text: np.ndarray, sigma: int, sample: int = 16):
        order = suffix_array(text)
        previous = text[order - 1]
        n = len(text)
        self.levels = range(max(1, int(sigma).bit_length()) - 1, -1, -1)
        self.before = np.zeros(sigma + 2, dtype=np.int64)  # symbols smaller than each one
        np.cumsum(np.bincount(text, minlength=sigma + 1), out=self.before[1:])
        self.ones, self.zeros = [], []
        current = previous
        for level in self.levels:
            bit = (current >> level) & 1
            ones = np.zeros(n + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(n - int(ones[-1]))
            current = np.concatenate([current[bit == 0], current[bit == 1]])
        symbols = np.arange(sigma + 1)
        self.base = self._down(symbols, np.zeros(sigma + 1, dtype=np.int64))
        # every place after a break is sampled: a walk to the left never has to cross one
        self.sampled = (order % sample == 0) | (previous == BREAK)
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.sample_place = order[self.sampled]

    def _down(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for level, ones, zeros in zip(self.levels, self.ones, self.zeros, strict=True):
            up = ones[place]
            place = np.where((symbol >> level) & 1, zeros + up, place - up)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place in the transformed text."""
        return self._down(symbol, place) - self.base[symbol]

    def _left(self, row: np.ndarray) -> np.ndarray:
        """The rows of the suffixes that are one symbol longer."""
        symbol, place = np.zeros(len(row), dtype=np.int64), row
        for level, ones, zeros in zip(self.levels, self.ones, self.zeros, strict=True):
            up = ones[place]
            bit = ones[place + 1] - up
            place = np.where(bit, zeros + up, place - up)
            symbol |= bit.astype(np.int64) << level
        return self.before[symbol] + place - self.base[symbol]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Patterns that occur, with the first row and the row after the last of each.

        A pattern's symbols fill a row of ``patterns`` from the right; symbols are all 1 or more.
        """
        alive = np.arange(len(patterns))
        width = patterns.shape[1]
        low, high = np.zeros(len(alive), dtype=np.int64), np.full(len(alive), len(self.ones[0]) - 1, dtype=np.int64)
        for back in range(width):
            todo = lengths[alive] > back
            if not todo.any():
                break
            symbol = patterns[alive[todo], width - 1 - back]
            both = self.rank(np.concatenate([symbol, symbol]), np.concatenate([low[todo], high[todo]]))
            start = self.before[symbol]
            low[todo], high[todo] = start + both[: len(symbol)], start + both[len(symbol) :]
            found = low < high
            alive, low, high = alive[found], low[found], high[found]
        return alive, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of the suffixes at these rows."""
        place = np.empty(len(rows), dtype=np.int64)
        todo, row, steps = np.arange(len(rows)), rows, 0
        while len(todo):
            known = self.sampled[row]
            place[todo[known]] = self.sample_place[self.sample_rank[row[known]]] + steps
            todo, row = todo[~known], row[~known]
            row = self._left(row)
            steps += 1
        return place
