"""Words of whole texts as arrays: positions and hashes, straight from an Arrow column, without a Python string per word.

Words are maximal runs of bytes that are no separator in the UTF-8 form of the text. Equal words have equal hashes
everywhere, so hashes can choose partitions and join keys; different words share a 64-bit hash with probability 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
MIX = np.uint64(0xD6E8FEB86659FD93)

BLANKS = np.zeros(256, dtype=bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True

#: For comparing loosely: ASCII bytes that are no letter or digit separate, upper case counts as lower case.
MARKS = np.array([not (chr(b).isalnum() or b >= 128) for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    return h ^ (h >> np.uint64(29))


@dataclass
class Words:
    """`start` and `end` are byte positions in `data`; words of document i are [first[i], first[i + 1])."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Start word and hash of every run of `n` words inside one document."""
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self.hashes))
        at = np.flatnonzero(left >= n)
        return at, run_hashes(self.hashes, at, n)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def run_hashes(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    total, factor = np.zeros(len(at), dtype=np.uint64), np.uint64(1)
    with np.errstate(over="ignore"):
        for j in range(n):
            total += hashes[at + j] * factor
            factor = factor * STEP
        return mixed(total)


def words_of(texts: pa.Array, separators: np.ndarray = BLANKS, fold: np.ndarray | None = None) -> Words:
    """The words of each text; nulls have none. `fold` maps bytes before they are looked at."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, values = texts.buffers()
    edge = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    edge = edge.astype(np.int64)
    data = np.frombuffer(values, dtype=np.uint8)[edge[0] : edge[-1]] if values else np.zeros(0, dtype=np.uint8)
    edge = edge - edge[0]
    if fold is not None:
        data = fold[data]
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return Words(data, none, none, np.zeros(len(texts) + 1, dtype=np.int64), none.astype(np.uint64))
    inside = ~separators[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    seams = edge[1:-1]
    seams = seams[(seams > 0) & (seams < len(data))]
    opens[seams] |= inside[seams]
    closes[seams - 1] |= inside[seams - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    first = np.searchsorted(start, edge)
    with np.errstate(over="ignore"):
        power = np.full(len(data), BASE, dtype=np.uint64)
        power[0] = 1
        np.cumprod(power, out=power)
        total = (data.astype(np.uint64) + np.uint64(1)) * power
        np.cumsum(total, out=total)
        before = np.where(start > 0, total[np.maximum(start - 1, 0)], np.uint64(0))
        power = np.full(len(data), BASE_INVERSE, dtype=np.uint64)
        power[0] = 1
        np.cumprod(power, out=power)
        hashes = mixed((total[end - 1] - before) * power[start])
    return Words(data, start, end, first, hashes)


def portions(batch: pa.RecordBatch | pa.Table, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """`batch` in slices of about `limit` bytes of text, one row at least, so that memory follows the longest text only."""
    texts = batch.column(column)
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64))
    at = 0
    while at < len(size):
        base = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to
