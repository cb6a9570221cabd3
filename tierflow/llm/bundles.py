"""Questions that documents ask of hash-partitioned tables, and the answers brought back to them.

Asking for every word run of every document as a row of its own would shuffle many times the text. Instead documents are
bundled: a bundle holds about `BUNDLE_BYTES` of text, compressed, and has a number that is stored with it. A bundle asks
each distinct key once, as one binary row per bucket of the hash space; whoever holds the bucket answers in the order of
the keys; and the answers meet their bundle in a cogroup, where the same keys are made again in the same order.

A key that every document has costs one entry per bundle, so no bucket is hot. A bundle and a bucket fit in one task: the
first by construction (or is one document), the second because their number follows the session's parallelism.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.shared import parallelism, quoted, stored
from tierflow.llm.words import portions, words_of

BUNDLE_BYTES = 8 << 20
PORTION_BYTES = 2 << 20
KEY_BYTES = 6
ANSWERS = "unit bigint, kind int, bucket int, answer binary, amount bigint"


def packed(table: pa.RecordBatch | pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write(table)
    return sink.getvalue().to_pybytes()


def unpacked(blob: bytes | pa.Buffer) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(blob)).read_all()


def bundled(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """A stored table (unit, blob) of all documents' `id` and `text`."""
    rows = docs.select(F.col(quoted(doc_id)).alias("id"), F.col(quoted(text)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        unit = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in portions(batch, "text", BUNDLE_BYTES):
                yield pa.RecordBatch.from_arrays([pa.array([unit], pa.int64()), pa.array([packed(part)])], ["unit", "blob"])
                unit += 1

    return stored(rows.mapInArrow(run, "unit bigint, blob binary"), "bundles")


def buckets_for(df: DataFrame) -> int:
    """A power of two of at least twice the session's parallelism."""
    return 1 << max(4, (2 * parallelism(df) - 1).bit_length())


@dataclass
class Hashed:
    """Word hashes of a bundle's documents; document i has words [first[i], first[i + 1]).

    With `spans` also the bytes of all texts, and where in them each word begins and ends.
    """

    hashes: np.ndarray
    first: np.ndarray
    data: np.ndarray | None = None
    start: np.ndarray | None = None
    end: np.ndarray | None = None

    @classmethod
    def of(cls, table: pa.Table, spans: bool = False) -> Hashed:
        hashes, counts = [np.zeros(0, dtype=np.uint64)], [np.zeros(1, dtype=np.int64)]
        none = np.zeros(0, dtype=np.int64)
        data, start, end, size = [none.astype(np.uint8)], [none], [none], 0
        for batch in table.to_batches():
            for part in portions(batch, "text", PORTION_BYTES):
                words = words_of(part.column("text"))
                hashes.append(words.hashes)
                counts.append(words.counts)
                if spans:
                    data.append(words.data)
                    start.append(words.start + size)
                    end.append(words.end + size)
                    size += len(words.data)
        found = np.concatenate(hashes), np.cumsum(np.concatenate(counts))
        return cls(*found, *map(np.concatenate, (data, start, end))) if spans else cls(*found)

    def starts(self, n: int) -> np.ndarray:
        """Words at which a run of `n` words inside one document begins."""
        left = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.hashes))
        return np.flatnonzero(left >= n)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def bucket_edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted `keys`; a bucket is a range of the hash space."""
    width = np.uint64(64 - (buckets.bit_length() - 1))
    return np.concatenate([np.searchsorted(keys, np.arange(buckets, dtype=np.uint64) << width), [len(keys)]])


def short(keys: np.ndarray, buckets: int) -> bytes:
    """Sorted keys of one bucket by the `KEY_BYTES` bytes that follow the bits of the bucket."""
    low = (keys << np.uint64(buckets.bit_length() - 1)).astype(">u8")
    return low.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def long(keys: bytes) -> np.ndarray:
    out = np.zeros((len(keys) // KEY_BYTES, 8), dtype=np.uint8)
    out[:, :KEY_BYTES] = np.frombuffer(keys, dtype=np.uint8).reshape(-1, KEY_BYTES)
    return out.reshape(-1).view(">u8").astype(np.uint64)


def asked(
    bundles: DataFrame, ask: Callable[[pa.Table], Iterator[tuple]], columns: dict[str, str]
) -> DataFrame:
    """Rows (bucket, unit, ...) that `ask` makes of each bundle; it yields (bucket, *values of `columns`)."""
    arrow = {"binary": pa.binary(), "bigint": pa.int64(), "int": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, blob in zip(batch.column("unit").to_pylist(), batch.column("blob")):
                rows = list(ask(unpacked(blob.as_buffer())))
                if rows:
                    values = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32(), *map(arrow.get, columns.values())])]
                    yield pa.RecordBatch.from_arrays([pa.array([unit] * len(rows), pa.int64()), *values],
                                                     ["unit", "bucket", *columns])

    schema = ", ".join(["unit bigint", "bucket int", *(f"{n} {t}" for n, t in columns.items())])
    return bundles.mapInArrow(run, schema)


def answered(questions: DataFrame, answer: Callable[[pa.Table], list[tuple[bytes, int]]], kind: int) -> DataFrame:
    """Stored answers (`ANSWERS`), one per question: `answer` gets all questions of a bucket and gives bytes and a number."""

    def run(group: pa.Table) -> pa.Table:
        answers = answer(group.combine_chunks())
        return pa.table(
            {
                "unit": group.column("unit"),
                "kind": pa.array([kind] * group.num_rows, pa.int32()),
                "bucket": group.column("bucket"),
                "answer": pa.array([a for a, _ in answers], pa.binary()),
                "amount": pa.array([n for _, n in answers], pa.int64()),
            }
        )

    return stored(questions.groupBy("bucket").applyInArrow(run, ANSWERS), "answers")


def met(
    bundles: DataFrame, answers: DataFrame, use: Callable[[pa.Table, Callable[[int], list[bytes]]], pa.Table], schema: str
) -> DataFrame:
    """What `use` makes of each bundle and its answers; it gets a function from a kind to its answers in bucket order."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds, order = right.column("kind").to_numpy(), right.column("bucket").to_numpy()
        column = right.column("answer")

        def of(kind: int) -> list[bytes]:
            mine = np.flatnonzero(kinds == kind)
            return [column[int(i)].as_buffer() for i in mine[np.argsort(order[mine], kind="stable")]]

        return use(unpacked(left.column("blob")[0].as_buffer()), of)

    return bundles.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(run, schema)
