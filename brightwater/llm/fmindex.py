"""An FM-index over word numbers: suffix order, wavelet matrix with packed bits, backward search."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector that counts its ones before any place: packed words and a count before each."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, dtype=np.uint8)]).view(np.uint64)
        self.before = np.zeros(len(self.words), dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])
        self.ones = int(bits.sum())
        self.zeros = n - self.ones

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FMIndex:
    """Over a text of numbers 0..sigma-1, where 0 parts the pieces and occurs in no pattern.

    Suffixes are ordered by their first ``depth`` numbers (prefix doubling),
    which is enough for patterns of fewer than ``depth`` numbers.
    """

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
        length = 1
        order = np.argsort(rank, kind="stable")
        while length < depth and n:
            later = np.full(n, -1, dtype=np.int64)
            later[: max(0, n - length)] = rank[length:]
            key = rank * (n + 1) + later + 1
            order = np.argsort(key, kind="stable")
            new = np.zeros(n, dtype=np.int64)
            new[1:] = np.cumsum(key[order][1:] != key[order][:-1])
            rank[order] = new
            length *= 2
        sigma = int(text.max()) + 1 if n else 1
        self.size = n
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))]).astype(np.int64)
        last = text[order - 1]  # the number before each suffix; the text's last one before its start
        self.levels: list[Bits] = []
        starts = np.zeros(sigma, dtype=np.int64)
        symbols = np.arange(sigma)
        for shift in range(max(1, (sigma - 1).bit_length()) - 1, -1, -1):
            ones = (last >> shift) & 1 == 1
            level = Bits(ones)
            self.levels.append(level)
            last = np.concatenate([last[~ones], last[ones]])
            taken = level.rank(starts)
            starts = np.where((symbols >> shift) & 1 == 1, level.zeros + taken, starts - taken)
        self.starts = starts

    def step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the suffixes that put ``symbol`` before those from ``at`` on begin."""
        place, top = at, len(self.levels) - 1
        for i, level in enumerate(self.levels):
            taken = level.rank(place)
            place = np.where((symbol >> (top - i)) & 1 == 1, level.zeros + taken, place - taken)
        return self.first[symbol] + place - self.starts[symbol]

    def search(self, text: np.ndarray, starts: np.ndarray, length: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """The suffix intervals of the patterns ``text[s:s+length]``, by backward search.

        A pattern is given up as soon as fewer than ``least`` suffixes begin with
        what has been read of it; its interval is then the one reached.
        """
        low, high = np.zeros(len(starts), dtype=np.int64), np.full(len(starts), self.size, dtype=np.int64)
        active = np.arange(len(starts))
        for k in range(length - 1, -1, -1):
            symbol = text[starts[active] + k]
            low[active], high[active] = self.step(symbol, low[active]), self.step(symbol, high[active])
            active = active[high[active] - low[active] >= least]
        return low, high
