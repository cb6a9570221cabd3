"""Repeated passages across documents, by FM-indexes over shards of the text.

A window is `WINDOW` consecutive words. Each window is represented by its minimizer: the least hash among the runs of
WINDOW // 2 words in it. Equal windows have equal minimizers, so all occurrences of a window are looked up in one shard of
the hash space, and only windows whose minimizer occurs in two documents need to be. Neighbouring windows with the same
minimizer form a segment.

1. Bundles of documents ask which of their minimizers occur in documents with different ids.
2. They send the distinct segments around those, with the smallest id that has them, to the shard of the minimizer. A shard
   builds a compressed FM-index of its distinct segments and streams them through it from right to left by backward search,
   a match being cut back to WINDOW words (the block of suffixes that agree in so many) after each step. A window's
   matching statistic thus reaches WINDOW on the suffix interval of its occurrences, and the answer is the smallest id there.
3. Where the answer is smaller than a document's own id, the words of the window are removed.

A passage in a third of all documents costs one segment per bundle, not per document. Segments travel as text; words, and
whole segments, are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tierflow.llm.bundles import (
    Hashed,
    answered,
    asked,
    bucket_edges,
    buckets_for,
    bundled,
    long,
    met,
    short,
    unpacked,
)
from tierflow.llm.fm_index import FMIndex
from tierflow.llm.words import portions, run_hashes, words_of

WINDOW = 13
NO_ID = np.iinfo(np.int64).max
SHARED, EARLIEST = 0, 1


class Windows:
    """Windows of a bundle's documents: start word, document and minimizer."""

    def __init__(self, table: pa.Table, window: int, spans: bool = False):
        self.words = words = Hashed.of(table, spans)
        self.window = window
        self.start = words.starts(window)
        run = max(1, window // 2)
        grams = words.starts(run)
        least = np.full(len(words.hashes), np.iinfo(np.uint64).max, dtype=np.uint64)
        least[grams] = run_hashes(words.hashes, grams, run)
        reach = window - run + 1  # runs in a window
        span = 1
        while span < reach:  # minima over spans that double, then overlap
            step = min(span, reach - span)
            least[: len(least) - step] = np.minimum(least[: len(least) - step], least[step:])
            span += step
        self.minimizer = least[self.start]
        self.doc = words.owner()[self.start]
        ids = table.column("id").combine_chunks()
        # A document without an id comes after all others.
        self.ids = np.asarray(ids.fill_null(NO_ID)).astype(np.int64)
        self.keys, self.key = np.unique(self.minimizer, return_inverse=True)

    def id_range(self) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest id of the documents in which each minimizer occurs."""
        low, high = np.full(len(self.keys), NO_ID), np.full(len(self.keys), np.iinfo(np.int64).min)
        np.minimum.at(low, self.key, self.ids[self.doc])
        np.maximum.at(high, self.key, self.ids[self.doc])
        return low, high

    def segments(self, shared: np.ndarray) -> Segments:
        return Segments(self, np.flatnonzero(shared[self.key]))


class Segments:
    """Maximal runs of neighbouring windows with the same shared minimizer; equal ones are numbered alike.

    Numbers go by minimizer, so that those of a shard are consecutive, and depend on the bundle alone.
    """

    def __init__(self, w: Windows, chosen: np.ndarray):
        self.chosen = chosen  # windows in segments
        start, doc, key = w.start[chosen], w.doc[chosen], w.key[chosen]
        fresh = np.ones(len(chosen), dtype=bool)
        fresh[1:] = (np.diff(start) != 1) | (np.diff(doc) != 0) | (np.diff(key) != 0)
        self.head = np.flatnonzero(fresh)
        self.of = np.cumsum(fresh) - 1  # segment occurrence of each chosen window
        self.count = np.diff(np.append(self.head, len(chosen)))  # windows of each occurrence
        self.begin = start[self.head]
        self.doc = doc[self.head]
        length = self.count + w.window - 1
        # Hash of the whole segment from its windows' hashes and its length.
        window_hash = run_hashes(w.words.hashes, start, w.window)
        with np.errstate(over="ignore"):
            place = np.arange(len(chosen)) - self.head[self.of]
            power = np.cumprod(np.full(int(self.count.max(initial=1)), 0xC2B2AE3D27D4EB4F, dtype=np.uint64))
            total = np.add.reduceat(window_hash * power[place], self.head) if len(chosen) else window_hash
            mark = total + length.astype(np.uint64)
        order = np.lexsort((mark, w.minimizer[chosen][self.head])) if len(chosen) else self.head
        new = np.ones(len(order), dtype=bool)
        new[1:] = (np.diff(mark[order]) != 0) | (np.diff(key[self.head][order]) != 0)
        self.number = np.empty(len(order), dtype=np.int64)
        self.number[order] = np.cumsum(new) - 1
        self.first = order[new]  # an occurrence of each distinct segment
        self.minimizer = w.minimizer[chosen][self.head][self.first]
        self.earliest = np.full(len(self.first), NO_ID)
        np.minimum.at(self.earliest, self.number, w.ids[self.doc])
        self.length = length[self.first]


def passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_removed, kept_sha256, removed (intervals of words, end exclusive).

    A word is removed if a window that covers it also starts in a document with a smaller id; windows are judged on the
    input. Null ids come after all others and are not smaller than each other; rows with one id do not repeat each other.
    Null and empty texts have no words. An empty table gives an empty result.
    """
    bundles = bundled(docs, text, doc_id)
    buckets = buckets_for(docs)
    id_type = docs.select(doc_id).schema[0].dataType.simpleString()

    def ask_shared(table: pa.Table) -> Iterator[tuple]:
        w = Windows(table, window)
        low, high = w.id_range()
        edges = bucket_edges(w.keys, buckets)
        for b in np.flatnonzero(np.diff(edges)).tolist():
            part = slice(edges[b], edges[b + 1])
            yield b, short(w.keys[part], buckets), low[part].tobytes(), (high[part] - low[part] > 0).tobytes()

    def answer_shared(group: pa.Table) -> list[tuple[bytes, int]]:
        each = [long(k.as_buffer()) for k in group.column("keys")]
        ids = np.concatenate([np.frombuffer(c.as_buffer(), dtype=np.int64) for c in group.column("ids")])
        several = np.concatenate([np.frombuffer(c.as_buffer(), dtype=bool) for c in group.column("several")])
        keys, place = np.unique(np.concatenate(each), return_inverse=True)
        low, high = np.full(len(keys), NO_ID), np.full(len(keys), np.iinfo(np.int64).min)
        np.minimum.at(low, place, ids)
        np.maximum.at(high, place, ids)
        shared = low < high
        shared[place[several]] = True
        cuts = np.cumsum([len(k) for k in each])[:-1]
        return [(np.packbits(s).tobytes(), len(s)) for s in np.split(shared[place], cuts)]

    shared = answered(
        asked(bundles, ask_shared, {"keys": "binary", "ids": "binary", "several": "binary"}), answer_shared, SHARED
    )

    def flags(w: Windows, answers: list) -> np.ndarray:
        """Whether each minimizer of the bundle is shared."""
        edges = bucket_edges(w.keys, buckets)
        sizes = np.diff(edges)
        parts = [np.unpackbits(np.frombuffer(a, dtype=np.uint8), count=int(n)) for a, n in zip(answers, sizes[sizes > 0])]
        return np.concatenate([np.zeros(0, dtype=np.uint8), *parts]).astype(bool)

    def send(table: pa.Table, of) -> pa.Table:
        w = Windows(table, window, spans=True)
        s = w.segments(flags(w, of(SHARED)))
        edges = bucket_edges(s.minimizer, buckets)
        begin, end = w.words.start[s.begin[s.first]], w.words.end[s.begin[s.first] + s.length - 1]
        full = np.flatnonzero(np.diff(edges))
        data = w.words.data.tobytes()
        words = []
        for b in full:
            low, high = edges[b], edges[b + 1]
            words.append(squeezed(b" ".join([data[x:y] for x, y in zip(begin[low:high].tolist(), end[low:high].tolist())])))
        return pa.table(
            {
                "bucket": pa.array(full.astype(np.int32)),
                "words": pa.array(words, pa.binary()),
                "lengths": pa.array([s.length[edges[b] : edges[b + 1]].astype(np.int64).tobytes() for b in full], pa.binary()),
                "ids": pa.array([s.earliest[edges[b] : edges[b + 1]].tobytes() for b in full], pa.binary()),
            }
        )

    def answer_earliest(group: pa.Table) -> list[tuple[bytes, int]]:
        lengths = [np.frombuffer(c.as_buffer(), dtype=np.int64) for c in group.column("lengths")]
        ids = np.concatenate([np.frombuffer(c.as_buffer(), dtype=np.int64) for c in group.column("ids")])
        words = np.concatenate([hashes_of(c.as_buffer()) for c in group.column("words")])
        found = earliest_ids(words, np.concatenate(lengths), ids, window)
        sizes = [int((n - window + 1).sum()) for n in lengths]
        return [(part.tobytes(), len(part)) for part in np.split(found, np.cumsum(sizes)[:-1])]

    questions = with_unit(bundles, shared, send)
    earliest = answered(questions, answer_earliest, EARLIEST)

    def remove(table: pa.Table, of) -> pa.Table:
        w = Windows(table, window)
        s = w.segments(flags(w, of(SHARED)))
        answers = np.concatenate([np.zeros(0, dtype=np.int64), *(np.frombuffer(a, dtype=np.int64) for a in of(EARLIEST))])
        # Answers hold the windows of the distinct segments in the order of their numbers.
        base = np.cumsum(s.length - window + 1) - (s.length - window + 1)
        place = np.arange(len(s.chosen)) - s.head[s.of] if len(s.chosen) else s.of
        repeats = answers[base[s.number[s.of]] + place] < w.ids[w.doc[s.chosen]] if len(s.chosen) else s.of.astype(bool)
        change = np.zeros(len(w.words.hashes) + 1, dtype=np.int64)
        starts = w.start[s.chosen[repeats]]
        np.add.at(change, starts, 1)
        np.add.at(change, starts + window, -1)
        return results(table, w.words.first, np.cumsum(change[:-1]) > 0)

    schema = (
        f"doc_id {id_type}, n_words bigint, n_removed bigint, kept_sha256 string,"
        " removed array<struct<start:int,end:int>>"
    )
    return met(bundles, shared.unionAll(earliest), remove, schema)


def squeezed(text: bytes) -> bytes:
    return len(text).to_bytes(8, "little") + pa.compress(text, codec="zstd", asbytes=True)


def hashes_of(blob: pa.Buffer) -> np.ndarray:
    """Word hashes of a squeezed text."""
    data = blob.to_pybytes()
    text = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return words_of(pa.array([text], pa.binary())).hashes


def earliest_ids(words: np.ndarray, lengths: np.ndarray, ids: np.ndarray, window: int) -> np.ndarray:
    """For every window of every segment, in order: the smallest id of the segments in which it occurs."""
    ends = np.cumsum(lengths)
    begins = ends - lengths
    # Equal segments of several bundles are indexed once, with their smallest id, and answered alike.
    number = np.arange(len(words)) - np.repeat(begins, lengths)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(int(lengths.max(initial=1)), 0x9FB21C651E98DF25, dtype=np.uint64))
        mark = np.add.reduceat(words * power[number], begins) + lengths.astype(np.uint64)
    _, one, same = np.unique(mark, return_index=True, return_inverse=True)
    earliest = np.full(len(one), NO_ID)
    np.minimum.at(earliest, same, ids)
    chosen = lengths[one]
    own = np.repeat(begins[one] - (np.cumsum(chosen) - chosen), chosen) + np.arange(chosen.sum())
    found = streamed(words[own], chosen, earliest, window)
    # Answers of the distinct segments, handed to each segment.
    count = lengths - window + 1
    base = (np.cumsum(count[one]) - count[one])[same]
    return found[np.repeat(base - (np.cumsum(count) - count), count) + np.arange(count.sum())]


#: Windows of a long segment are streamed in pieces of so many, all pieces together.
PIECE = 64


def streamed(words: np.ndarray, lengths: np.ndarray, ids: np.ndarray, window: int) -> np.ndarray:
    """As `earliest_ids`, for distinct segments: index them, then stream them from right to left."""
    _, symbol = np.unique(words, return_inverse=True)
    piece = np.repeat(np.arange(len(lengths)), lengths)
    text = np.zeros(len(words) + len(lengths), dtype=np.int64)
    text[np.arange(len(words)) + piece] = symbol + 1  # a separator follows each segment
    index = FMIndex(text, window)
    owner = np.repeat(np.arange(len(lengths)), lengths + 1)
    # The smallest id in each block of suffixes that agree in `window` words.
    least = np.minimum.reduceat(ids[owner[index.suffixes]], index.block_start)

    count = lengths - window + 1
    pieces = -(-count // PIECE)
    part = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    of = np.repeat(np.arange(len(lengths)), pieces)
    first = part * PIECE  # first window of each piece, and how many it has
    many = np.minimum(PIECE, count[of] - first)
    begin = (np.cumsum(lengths + 1) - lengths - 1)[of]
    answer = (np.cumsum(count) - count)[of] + first
    out = np.empty(count.sum(), dtype=np.int64)
    at = begin + first + many - 1 + window  # just behind the last window
    low = np.zeros(len(of), dtype=np.int64)
    for _ in range(window):
        at = at - 1
        low = index.extend(text[at], low)
    live = np.arange(len(of))
    for step in range(PIECE):
        block = index.block[low]
        out[(answer + many)[live] - 1 - step] = least[block]
        going = many[live] > step + 1
        live, at, block = live[going], at[going] - 1, block[going]
        if not len(live):
            break
        low = index.extend(text[at], index.block_start[block])
    return out


def with_unit(bundles: DataFrame, shared: DataFrame, send) -> DataFrame:
    """Questions that `send` makes of each bundle and its answers, with the number of the bundle."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("bucket").to_numpy(), kind="stable")
        column = right.column("answer")
        out = send(unpacked(left.column("blob")[0].as_buffer()), lambda kind: [column[int(i)].as_buffer() for i in order])
        unit = left.column("unit")[0].as_py()
        return out.add_column(0, "unit", pa.array([unit] * out.num_rows, pa.int64()))

    schema = "unit bigint, bucket int, words binary, lengths binary, ids binary"
    return bundles.groupBy("unit").cogroup(shared.groupBy("unit")).applyInArrow(run, schema)


def results(table: pa.Table, first: np.ndarray, gone: np.ndarray) -> pa.Table:
    """Counts, digest of the kept words and removed intervals of each document."""
    digests, removed, doc = [], [], 0
    total = np.concatenate([[0], np.cumsum(gone)])
    for batch in table.to_batches():
        for part in portions(batch, "text"):
            words = words_of(part.column("text"))
            for i in range(part.num_rows):
                low, high = int(first[doc]), int(first[doc + 1])
                mine = gone[low:high]
                data = words.data[words.start[words.first[i]] : words.end[words.first[i + 1] - 1]].tobytes() if high > low else b""
                kept = data.split()
                if total[high] > total[low]:
                    kept = [w for w, g in zip(kept, mine.tolist()) if not g]
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8)))
                    removed.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])])
                else:
                    removed.append([])
                digests.append(sha256(b" ".join(kept)).hexdigest())
                doc += 1
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.table(
        {
            "doc_id": table.column("id"),
            "n_words": pa.array(np.diff(first).astype(np.int64)),
            "n_removed": pa.array((total[first[1:]] - total[first[:-1]]).astype(np.int64)),
            "kept_sha256": pa.array(digests, pa.string()),
            "removed": pa.array(removed, kind),
        }
    )
