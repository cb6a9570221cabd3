"""Stupid-backoff language model scores.

S(w | h) = c(hw) / c(h) where the run hw was seen `least` times or more, else `DISCOUNT` times the score of w after the
shorter history; at the end c(w) / N, where a word that was never seen counts as `DISCOUNT` of one. A document of the corpus
that is scored by it may be left out (`leave_out`): what it says itself is taken off every count and off N, so that its
runs are unseen unless another document has them, and scores back off. Count tables are partitioned by hash of the run. Every bundle of documents asks for
the counts of its distinct runs, of one length after the other so that only one length's questions are on disk at a time;
a bucket adds up what all bundles say they have and answers with the totals, and scores are summed per document where the
answers come back (see `bundles`). All counts are over all documents, and what is gathered grows with the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.bundles import Hashed, answered, asked, bucket_edges, buckets_for, bundled, long, met, short
from tierflow.llm.words import mixed, run_hashes

ORDER, LEAST, DISCOUNT = 3, 2, 0.4
#: Occurrences that are sorted at a time.
PORTION = 100_000


def runs_of(words: Hashed, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of `n` words, and their hashes."""
    at = words.starts(n)
    with np.errstate(over="ignore"):
        return at, mixed(run_hashes(words.hashes, at, n) + np.uint64(n))


def in_own_document(owner: np.ndarray, run: np.ndarray) -> np.ndarray:
    """For every occurrence of a run how often its own document has the run; occurrences stand in the order of documents."""
    found = np.empty(len(run))
    at = 0
    while at < len(run):
        # Whole documents, a portion at a time, so that sorting needs little memory.
        to = int(np.searchsorted(owner, owner[min(at + PORTION, len(run)) - 1], side="right"))
        _, place = np.unique(run[at:to], return_inverse=True)
        place += (owner[at:to] - owner[at]) * (int(place.max()) + 1)
        _, place, counts = np.unique(place, return_inverse=True, return_counts=True)
        found[at:to] = counts[place]
        at = to
    return found


def backoff_scores(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", order: int = ORDER, least: int = LEAST, leave_out: bool = False
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, log_score (sum of natural logs), mean_log_score (per word), n_backed_off
    (words whose longest history was given up).

    Null and empty texts have no words, a sum of 0 and a null mean. Repeated rows count as often as they occur, each a
    document of its own; null ids are kept. An empty table gives an empty result. Extra columns are ignored.
    """
    bundles = bundled(docs, text, doc_id)
    buckets = buckets_for(docs)
    id_type = docs.select(doc_id).schema[0].dataType.simpleString()

    def answer(group: pa.Table) -> list[tuple[bytes, int]]:
        each = [long(k.as_buffer()) for k in group.column("keys")]
        counts = np.concatenate([np.frombuffer(c.as_buffer(), dtype=np.uint32) for c in group.column("counts")])
        distinct, place = np.unique(np.concatenate(each), return_inverse=True)
        total = np.bincount(place, weights=counts, minlength=len(distinct))[place].astype(np.uint32)
        cuts = np.cumsum([len(k) for k in each])[:-1]
        return list(zip((t.tobytes() for t in np.split(total, cuts)), group.column("words").to_pylist()))

    def counted(n: int) -> DataFrame:
        def ask(table: pa.Table) -> Iterator[tuple]:
            words = Hashed.of(table)
            keys, counts = np.unique(runs_of(words, n)[1], return_counts=True)
            edges = bucket_edges(keys, buckets)
            for b in range(buckets):
                low, high = edges[b], edges[b + 1]
                said = len(words.hashes) if n == 1 and b == 0 else 0
                yield b, short(keys[low:high], buckets), counts[low:high].astype(np.uint32).tobytes(), said

        questions = asked(bundles, ask, {"keys": "binary", "counts": "binary", "words": "bigint"})
        return answered(questions, answer, n)

    answers = reduce(DataFrame.union, [counted(n) for n in range(1, order + 1)])
    total = answers.agg(F.sum("amount")).first()[0] or 0

    def use(table: pa.Table, of) -> pa.Table:
        words = Hashed.of(table)
        owner = words.owner()
        others = np.maximum(total - np.diff(words.first) * leave_out, 1)
        score, history = np.zeros(len(words.hashes)), np.zeros(len(words.hashes))
        given_up = np.zeros(len(words.hashes), dtype=bool)
        for n in range(1, order + 1):
            at, keys = runs_of(words, n)
            _, place = np.unique(keys, return_inverse=True)
            counts = np.concatenate([np.frombuffer(a, dtype=np.uint32) for a in of(n)])[place].astype(float)
            if leave_out:
                counts -= in_own_document(owner[at], place)
            # Of the word that a run of n words ends with: its score by the shorter histories, discounted, or by this one.
            last = at + n - 1
            seen = counts >= least if n > 1 else np.ones(len(at), dtype=bool)
            among = others[owner] if n == 1 else np.maximum(history[at], 1)
            score[last] = np.where(seen, np.log(np.where(counts > 0, counts, DISCOUNT) / among), np.log(DISCOUNT) + score[last])
            given_up[last] = ~seen
            history[:] = 0
            history[at] = counts
        size = np.diff(words.first)
        full = size > 0
        # Summed from each document's own start, so that a score does not depend on its neighbours.
        log_score = np.zeros(len(size))
        if full.any():
            log_score[full] = np.add.reduceat(score, words.first[:-1][full])
        return pa.table(
            {
                "doc_id": table.column("id"),
                "n_words": pa.array(size.astype(np.int64)),
                "log_score": pa.array(log_score),
                "mean_log_score": pa.array(log_score / np.maximum(size, 1), mask=~full),
                "n_backed_off": pa.array(np.bincount(owner[given_up], minlength=len(size)).astype(np.int64)),
            }
        )

    schema = f"doc_id {id_type}, n_words bigint, log_score double, mean_log_score double, n_backed_off bigint"
    return met(bundles, answers, use, schema)
