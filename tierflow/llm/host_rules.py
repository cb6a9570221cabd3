"""Host-level quality rules: documents are measured one by one, hosts are judged by how often theirs fail.

A host that fails a rule often is one thing, a host with two pages of which one fails another. Each rule's failure rates
over all hosts are therefore read as draws from a beta distribution, fitted by moments; a host's rate is shrunk towards
that prior by the prior's weight, and a host whose shrunk rate of any rule reaches `LIMIT` is refused with all its documents.

Defined results: a null text is an empty one; rows with a null or blank host have no host verdict and stand by themselves;
repeated rows count as often as they occur; very long texts are measured whole; an empty table gives an empty result. Extra
columns are carried in `row` and never clash. A document also counts for its own host. Word, line and window equality rests
on 64-bit hashes within one document.

Scale: one pass over the texts, in portions, gives a few numbers per document, which are stored. Failures are summed per host
map-side, so a host with a third of all documents arrives as one row per task; the prior is five sums per rule over the table
of hosts. Verdicts come back by a plain equi-join that adaptive execution may broadcast, or split where a host is hot.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.shared import quoted, row_of, stored
from tierflow.llm.words import BLANKS, mixed, portions, words_of

#: A host is refused when a shrunk failure rate reaches this share of its documents.
LIMIT = 0.5
#: Correlation within hosts is taken as at least this: a prior weighs at most a million documents.
LEAST_CORRELATION = 1e-6
WINDOW = 3
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
PORTION_BYTES = 4 << 20

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", dtype=np.uint8)] = True
NOT_NEWLINE = np.arange(256) == 0x0A
OWNER_MIX = np.uint64(0x9FB21C651E98DF25)

#: What fails a document, in SQL over its measures; the base rules also drop it by itself.
BASE_RULES = {"short": "n_words < 50", "repetitive": "100 * n_repeat_words > 50 * n_words"}
HOST_RULES = BASE_RULES | {
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 3 * n_words OR word_chars > 10 * n_words",
}


@dataclass(frozen=True)
class Prior:
    """A beta distribution of failure rates: `failed` failures in `weight` documents."""

    failed: float
    weight: float


def in_groups(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal (owner, hash) are neighbours, and where in it each place equals the one before."""
    order = np.argsort(mixed(hashes + owner.astype(np.uint64) * OWNER_MIX), kind="stable")
    same = np.zeros(len(order), dtype=bool)
    same[1:] = (hashes[order[1:]] == hashes[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    return order, same


def measure(texts: pa.Array) -> list[np.ndarray]:
    """`MEASURES` of each text."""
    docs = len(texts)
    words = words_of(texts)
    size = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    edge = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(size)])

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(flags, dtype=np.int64)])
        return total[edge[1:]] - total[edge[:-1]]

    data = words.data
    chars = per_text(((data & 0xC0) != 0x80) & ~BLANKS[data])
    symbols = per_text(SYMBOLS[data])

    lines = words_of(texts, NOT_NEWLINE)
    with_word = np.searchsorted(words.start, lines.start) < np.searchsorted(words.start, lines.end)
    line_owner = lines.owner()[with_word]
    order, same = in_groups(line_owner, lines.hashes[with_word])
    repeated_lines = np.bincount(line_owner[order[same]], minlength=docs)

    at, grams = words.grams(WINDOW)
    order, same = in_groups(words.owner()[at], grams)
    twice = same.copy()
    twice[:-1] |= same[1:]
    covered = np.zeros(len(words.hashes), dtype=bool)
    for step in range(WINDOW):
        covered[at[order[twice]] + step] = True
    repeated = np.bincount(words.owner()[covered], minlength=docs)
    return [words.counts, chars, symbols, np.bincount(line_owner, minlength=docs), repeated_lines, repeated]


def measured(docs: DataFrame, text: str = "text", host: str = "source", columns: list[str] | None = None) -> DataFrame:
    """A stored table (row, host, *MEASURES): the document's `columns` (all without), its host in lower case, its measures."""
    kept = docs.select(*[quoted(c) for c in columns]) if columns is not None else docs
    row = F.struct(*[F.col(quoted(c)) for c in kept.columns]) if columns is not None else row_of(docs)
    rows = docs.select(row.alias("row"), F.nullif(F.lower(F.trim(F.col(quoted(host)))), F.lit("")).alias("host"),
                       F.col(quoted(text)).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, "text", PORTION_BYTES):
                found = [pa.array(v.astype(np.int64)) for v in measure(part.column("text"))]
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("host"), *found], ["row", "host", *MEASURES])

    schema = rows.drop("text").schema
    for name in MEASURES:
        schema = schema.add(name, T.LongType())
    return stored(rows.mapInArrow(run, schema), "measured")


def by_host(measures: DataFrame) -> DataFrame:
    """Documents and failures of each rule per host, stored."""
    failures = [F.sum(F.when(F.expr(rule), 1).otherwise(0)).alias(name) for name, rule in HOST_RULES.items()]
    return stored(measures.where("host IS NOT NULL").groupBy("host").agg(F.count(F.lit(1)).alias("n"), *failures), "hosts")


def priors(hosts: DataFrame) -> dict[str, Prior]:
    """The beta prior of each rule, from a handful of sums over all hosts.

    The correlation of failures within hosts is the variance between hosts' rates beyond what chance gives (the moment
    estimator for unequal sizes); its inverse less one is the prior's weight.
    """
    sums = [F.sum(c).alias(f"{c}_x") for c in HOST_RULES]
    squares = [F.sum(F.col(c).cast("double") * F.col(c) / F.col("n")).alias(f"{c}_xx") for c in HOST_RULES]
    total = hosts.agg(
        F.count(F.lit(1)).alias("hosts"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.col("n").cast("double") * F.col("n")), F.lit(0.0)).alias("nn"), *sums, *squares,
    ).first()
    return {c: prior(total["hosts"], total["n"], total["nn"], total[f"{c}_x"] or 0, total[f"{c}_xx"] or 0.0) for c in HOST_RULES}


def prior(hosts: int, n: int, nn: float, x: int, xx: float) -> Prior:
    """From the sums over hosts of 1, n, n², x and x²/n, where x of n documents failed."""
    mean = (x + 0.5) / (n + 1.0)
    chance = mean * (1 - mean)
    between = xx - 2 * mean * x + mean * mean * n - chance * (hosts - 1)
    spread = chance * (n - nn / n - (hosts - 1)) if n else 0.0
    correlation = min(max(between / spread if spread > 0 else 0.0, LEAST_CORRELATION), 1 - LEAST_CORRELATION)
    weight = 1 / correlation - 1
    return Prior(mean * weight, weight)


def shrunk(name: str, p: Prior) -> Column:
    return (F.col(name) + F.lit(p.failed)) / (F.col("n") + F.lit(p.weight))


def host_verdicts(hosts: DataFrame, limit: float = LIMIT) -> DataFrame:
    """(host, n, rate_<rule>, refused): the shrunk failure rates of each host and whether one of them reaches `limit`."""
    fitted = priors(hosts)
    rates = hosts.select("host", "n", *[shrunk(c, p).alias(f"rate_{c}") for c, p in fitted.items()])
    return rates.withColumn("refused", reduce(or_, (F.col(f"rate_{c}") >= F.lit(limit) for c in fitted)))


def judged_by_host(
    docs: DataFrame, text: str = "text", host: str = "source", columns: list[str] | None = None, limit: float = LIMIT
) -> DataFrame:
    """(row, host, *MEASURES, base_failed, host_refused, kept) for every document."""
    measures = measured(docs, text, host, columns)
    verdicts = host_verdicts(by_host(measures), limit).select(F.col("host").alias("v_host"), "refused")
    base = reduce(or_, map(F.expr, BASE_RULES.values()))
    refused = F.coalesce("refused", F.lit(False))
    joined = measures.join(verdicts, F.col("host") == F.col("v_host"), "left")
    return joined.select(
        "row", "host", *MEASURES, base.alias("base_failed"), refused.alias("host_refused"), (~base & ~refused).alias("kept")
    )
