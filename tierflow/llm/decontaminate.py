"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item share seeds: runs of `MIN_TILE` tokens with equal Karp-Rabin hashes. Adjoining seeds make
a match; the longest match is marked as a tile in both texts, then the next longest that does not overlap one (what is
left of an overlapped match competes again), until none of `MIN_TILE` tokens is left. The share of the item's tokens
under tiles is its coverage. Since tiles may stand in any order, an item is found when its passages were moved about.

Tokens are runs of letters, digits and combining marks of any script in Unicode form NFKC, lower case; punctuation of any
kind separates. An item of fewer than `MIN_TILE` tokens but at least `SHORT` is one tile or none: it is found where all of
it stands in one run. An item of one or two tokens is a phrase of plain language and is never found. The benchmark is the query set: it is looked up in blocks of at most `BLOCK_BYTES` of text (or one item),
each with one pass over all documents that shuffles nothing, so no token or document can become a hot key.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.shared import quoted
from tierflow.llm.words import LOWER, MARKS, Words, portions, words_of

MIN_TILE, COVERAGE = 5, 0.5
#: Items of so many tokens at least are looked for.
SHORT = 3
BLOCK_BYTES = 16 << 20
SIEVE_BITS = 20


def tokens(texts: pa.Array) -> Words:
    """The tokens of each text; a null text has none. Texts in ASCII take the short way to the same tokens."""
    if not pc.all(pc.string_is_ascii(texts)).as_py():
        plain = pc.utf8_lower(pc.utf8_normalize(texts, form="NFKC"))
        texts = pc.replace_substring_regex(plain, pattern=r"[^\p{L}\p{N}\p{M}]+", replacement=" ")
        return words_of(texts)
    return words_of(texts, MARKS, LOWER)


@dataclass
class Items:
    """A block of the benchmark: hashes of its seeds in order, each with item and place; short items by length, hashed whole."""

    ids: list
    size: np.ndarray
    seed: np.ndarray
    item: np.ndarray
    place: np.ndarray
    sieve: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, ids: list, texts: list) -> Items:
        words = tokens(pa.array(texts, pa.string()))
        at, seed = words.grams(MIN_TILE)
        owner = words.owner()[at] if len(at) else at
        order = np.argsort(seed, kind="stable")
        sieve = np.zeros(1 << SIEVE_BITS, dtype=bool)
        sieve[(seed >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)] = True
        short = {}
        for n in range(SHORT, MIN_TILE):
            start, whole = words.grams(n)
            item = words.owner()[start] if len(start) else start
            mine = words.counts[item] == n
            rank = np.argsort(whole[mine], kind="stable")
            if len(rank):
                short[n] = whole[mine][rank], item[mine][rank]
        return cls(ids, words.counts, seed[order], owner[order], (at - words.first[owner])[order], sieve, short)


def item_blocks(benchmark: DataFrame, text: str, item_id: str) -> Iterator[Items]:
    """The items, a bounded block at a time; a null text has no tokens."""
    rows = benchmark.select(F.col(quoted(item_id)).alias("id"), F.col(quoted(text)).alias("text"))
    bulk = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * bulk // BLOCK_BYTES))
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).orderBy("id", "text").collect()
        yield Items.of([r["id"] for r in part], [r["text"] for r in part])


def tiles(item: np.ndarray, doc: np.ndarray) -> list[tuple[int, int, int]]:
    """(place in item, place in document, length) of the tiles, from seeds at these places."""
    order = np.lexsort((item, doc - item))
    item, slant = item[order], (doc - item)[order]
    breaks = np.flatnonzero((np.diff(slant) != 0) | (np.diff(item) != 1)) + 1
    begin, end = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(item)]])
    heap = [
        (-int(e - b + MIN_TILE - 1), int(item[b]), int(item[b] + slant[b])) for b, e in zip(begin, end)
    ]
    heapq.heapify(heap)
    found: list[tuple[int, int, int]] = []
    taken_item: set[int] = set()
    taken_doc: set[int] = set()
    while heap:
        length, i, j = heapq.heappop(heap)
        free = [k for k in range(-length) if i + k not in taken_item and j + k not in taken_doc]
        if len(free) == -length:
            found.append((i, j, -length))
            taken_item.update(range(i, i - length))
            taken_doc.update(range(j, j - length))
            continue
        for first, last in runs(free):
            if last - first + 1 >= MIN_TILE:
                heapq.heappush(heap, (first - last - 1, i + first, j + first))
    return found


def runs(numbers: list[int]) -> Iterator[tuple[int, int]]:
    start = None
    for k, n in enumerate(numbers):
        if start is None:
            start = n
        if k + 1 == len(numbers) or numbers[k + 1] != n + 1:
            yield start, n
            start = None


def whole_in(words: Words, items: Items) -> Iterator[tuple[int, int, float, list]]:
    """Short items that stand in a document as one run; the first of its places is told."""
    for n, (known, item) in items.short.items():
        at, seed = words.grams(n)
        near = np.flatnonzero(np.isin(seed, known))
        if not len(near):
            continue
        doc = words.owner()[at[near]]
        _, firsts = np.unique(np.stack([doc.astype(np.uint64), seed[near]]), axis=1, return_index=True)
        for k in firsts:
            d, h = int(doc[k]), seed[near[k]]
            spot = int(at[near[k]] - words.first[d])
            for i in item[np.searchsorted(known, h, "left") : np.searchsorted(known, h, "right")]:
                yield d, int(i), 1.0, [(0, spot, n)]


def found_in(texts: pa.Array, items: Items, coverage: float) -> Iterator[tuple[int, int, float, list]]:
    """(document, item, coverage, tiles) of each pair with enough of the item's tokens under tiles."""
    words = tokens(texts)
    yield from whole_in(words, items)
    at, seed = words.grams(MIN_TILE)
    near = np.flatnonzero(items.sieve[(seed >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)])
    at, seed = at[near], seed[near]
    low, high = np.searchsorted(items.seed, seed, "left"), np.searchsorted(items.seed, seed, "right")
    times = high - low
    if not times.sum():
        return
    hit = np.repeat(np.arange(len(at)), times)
    entry = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + low[hit]
    doc = words.owner()[at[hit]]
    place = at[hit] - words.first[doc]
    item = items.item[entry]
    order = np.lexsort((item, doc))
    cuts = np.flatnonzero((np.diff(doc[order]) != 0) | (np.diff(item[order]) != 0)) + 1
    for pair in np.split(order, cuts):
        d, i = int(doc[pair[0]]), int(item[pair[0]])
        # Seeds reach at most so many tokens of the item.
        if len(np.unique(items.place[entry[pair]])) * MIN_TILE < coverage * items.size[i]:
            continue
        tiled = tiles(items.place[entry[pair]], place[pair])
        share = sum(t[2] for t in tiled) / int(items.size[i])
        if share >= coverage:
            yield d, i, share, tiled


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    coverage: float = COVERAGE,
) -> DataFrame:
    """A row per document and item found in it: doc_id, item_id, coverage, tiles (item_start, doc_start, length in tokens).

    Null and empty texts hold nothing. Repeated rows are judged each for itself; items are too. Either table may be empty.
    """
    rows = docs.select(F.col(quoted(doc_id)).alias("id"), F.col(quoted(text)).alias("text"))
    kinds = [rows.schema["id"].dataType, benchmark.schema[item_id].dataType]
    schema = (
        f"doc_id {kinds[0].simpleString()}, item_id {kinds[1].simpleString()}, coverage double,"
        " tiles array<struct<item_start:int,doc_start:int,length:int>>"
    )

    def search(items: Items):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in portions(batch, "text"):
                    hits = list(found_in(part.column("text"), items, coverage))
                    if hits:
                        ids = part.column("id").take(pa.array([h[0] for h in hits]))
                        names = pa.array([items.ids[h[1]] for h in hits])
                        spans = [[dict(zip(("item_start", "doc_start", "length"), t)) for t in h[3]] for h in hits]
                        kind = pa.list_(pa.struct([(n, pa.int32()) for n in ("item_start", "doc_start", "length")]))
                        yield pa.RecordBatch.from_arrays(
                            [ids, names, pa.array([h[2] for h in hits]), pa.array(spans, kind)],
                            ["doc_id", "item_id", "coverage", "tiles"],
                        )

        return rows.mapInArrow(run, schema)

    return reduce(DataFrame.unionAll, map(search, item_blocks(benchmark, item_text, item_id)))


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_text: str = "text",
    item_id: str = "item_id",
    coverage: float = COVERAGE,
) -> DataFrame:
    """The rows of `docs` in which no item is found, with its columns."""

    def clean(items: Items):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in portions(batch, text):
                    keep = np.ones(part.num_rows, dtype=bool)
                    keep[[h[0] for h in found_in(part.column(text), items, coverage)]] = False
                    yield part.filter(pa.array(keep))

        return run

    return reduce(
        lambda df, items: df.mapInArrow(clean(items), docs.schema), item_blocks(benchmark, item_text, item_id), docs
    )
