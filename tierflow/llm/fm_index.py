"""A compressed full-text index over integer symbols: Burrows-Wheeler transform in a wavelet matrix, backward search.

Bits of the wavelet matrix are packed 64 to a word with a running count per word. Searches are vectorised: many patterns
are extended to the left by one symbol at a time, all together.
"""

from __future__ import annotations

import numpy as np

ONE = np.uint64(1)


class Bits:
    """Packed bits with rank."""

    def __init__(self, bits: np.ndarray):
        size = len(bits) // 64 + 1
        padded = np.zeros(size * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.int32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        word = at >> 6
        mask = (ONE << (at & 63).astype(np.uint64)) - ONE
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FMIndex:
    """Occurrences of patterns of at most `depth` symbols in a text of symbols 1, 2, ...; 0 separates, and ends, pieces.

    Suffixes are sorted by their first `depth` symbols, by doubling. Those that agree in all of them form a block, which is
    the suffix interval of that pattern of `depth` symbols.
    """

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        self.size = n
        rank, length = text.astype(np.int64), 1
        while length < depth:
            step = min(length, depth - length)
            following = np.full(n, -1, dtype=np.int64)
            following[: max(0, n - step)] = rank[step:]
            rank = dense_rank(rank * (n + 2) + following + 1)
            length += step
        order = np.argsort(rank, kind="stable")
        self.suffixes = order
        opens = np.ones(n, dtype=bool)
        opens[1:] = rank[order][1:] != rank[order][:-1]
        #: First entries of the blocks, and the block of each suffix entry.
        self.block_start = np.flatnonzero(opens)
        self.block = np.cumsum(opens) - 1
        top = int(text.max(initial=0))
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        last = text[order - 1].astype(np.int64)  # position -1 wraps to the final separator
        self.levels: list[tuple[int, Bits, int]] = []
        for bit in reversed(range(max(1, top.bit_length()))):
            bits = (last >> bit) & 1
            self.levels.append((bit, Bits(bits), int(n - bits.sum())))
            last = np.concatenate([last[bits == 0], last[bits == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs among the first `at` entries of the transform."""
        low, high = np.zeros(len(at), dtype=np.int64), at.astype(np.int64)
        for bit, bits, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            ones_low, ones_high = bits.ones(low), bits.ones(high)
            low = np.where(one, zeros + ones_low, low - ones_low)
            high = np.where(one, zeros + ones_high, high - ones_high)
        return high - low

    def extend(self, symbol: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Begin of the suffix intervals of the patterns with `symbol` put before them, from those of the patterns.

        The extended patterns must occur. If they have more than `depth` symbols, the entry found is one of the block that
        their first `depth` symbols have.
        """
        return self.below[symbol] + self.rank(symbol, low)


def dense_rank(values: np.ndarray) -> np.ndarray:
    order = np.argsort(values, kind="stable")
    rank = np.empty(len(values), dtype=np.int64)
    ordered = values[order]
    rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])]) if len(values) else []
    return rank
