"""Text quality by Bradley-Terry ranking.

Every text has a strength w . x over a few measures of its form. w is fitted by logistic loss over all pairs of a good
and a poor labelled row, on the differences of their measures: P(good beats poor) = sigmoid(w . (x - x')). The share of
poor rows among the labelled ones gives the quantile of the strengths at which texts are cut.

Measuring is built-in expressions over whole texts. All labelled rows teach. The loss over all pairs depends on a row
only through its strength and its measures, so a Newton step needs, for each narrow interval of strengths, the number of
good and of poor rows there and their summed measures and products: one pass over the measures, added up by Spark. The
driver gets at most `BINS` intervals of each kind, whatever the number of rows. The cut is an exact order statistic of
all strengths, found by counting in ever narrower intervals.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.shared import BLANK, quoted, row_of, sieve, sifted, stored

#: Strengths are compared by intervals, so many over their whole span; rows of one interval share its mean strength,
#: which moves weights by some 1e-4.
BINS = 2048
#: Not used by the fit, which takes all pairs; a test of hashed draws reads it.
RIVALS = 8
#: A text is good from this score on.
GOOD = 0.7
MEASURES = ("marks", "capitals", "variety", "echoes", "word_length", "digits", "same_lines", "stops", "length")


def measures(text: Column) -> Column:
    """The measures of a text as a struct of doubles; null counts as empty, and an empty text has zeros."""
    body = F.coalesce(text, F.lit(""))
    size = F.greatest(F.char_length(body), F.lit(1)).cast("double")
    words = F.array_remove(F.split(body, f"{BLANK}+"), "")
    count = F.size(words).cast("double")
    same = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.coalesce(a == b, F.lit(False)))
    lines = F.array_remove(F.split(body, "\n"), "")

    def share(pattern: str) -> Column:
        return (F.char_length(body) - F.char_length(F.regexp_replace(body, pattern, ""))) / size

    return F.struct(
        F.sqrt(share(r"[^\p{L}\p{N}\x20\x09-\x0D.,;:'\"()?-]")).alias("marks"),
        F.sqrt(share(r"\p{Lu}")).alias("capitals"),
        # Herdan's measure: hardly depends on the length of ordinary prose.
        F.when(count > 1, F.log1p(F.size(F.array_distinct(words)).cast("double")) / F.log1p(count))
        .otherwise(F.lit(1.0)).alias("variety"),
        F.sqrt(F.size(F.array_remove(same, False)) / F.greatest(count, F.lit(1.0))).alias("echoes"),
        F.log1p(F.least(size / F.greatest(count, F.lit(1.0)), F.lit(200.0))).alias("word_length"),
        F.sqrt(share("[0-9]")).alias("digits"),
        F.when(F.size(lines) > 1, 1 - F.size(F.array_distinct(lines)) / F.size(lines)).otherwise(F.lit(0.0))
        .alias("same_lines"),
        F.sqrt(share(r"[.,;:]")).alias("stops"),
        F.log1p(count).alias("length"),
    )


@dataclass(frozen=True)
class Ranking:
    """Strength of a text is weights . measures - cut; without labels of both kinds there is nothing to rank by."""

    weights: tuple[float, ...] | None
    cut: float = 0.0

    def score(self, measured: Column) -> Column:
        """Between 0 and 1, `GOOD` or more from the cut on; 1 for all texts if nothing could be learned."""
        if self.weights is None:
            return F.lit(1.0)
        strength = sum((F.lit(w) * measured[m] for w, m in zip(self.weights, MEASURES)), F.lit(-self.cut))
        return 1 / (1 + F.exp(-(strength + F.lit(float(np.log(GOOD / (1 - GOOD)))))))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "quality") -> Ranking:
    """Learn from all labelled rows in `labels` (id, 0/1); leave held-out rows out of it beforehand.

    Null ids or labels, and labels of rows that do not exist, teach nothing. Reruns agree but for the last digits of the
    weights, as sums of doubles depend on the order of their terms.
    """
    id_type = docs.schema[doc_id].dataType
    chosen = labels.select(
        F.col(quoted(doc_id)).try_cast(id_type).alias("l_id"), F.col(quoted(label)).cast("int").alias("y")
    ).where("l_id IS NOT NULL AND y IN (0, 1)")
    # Rows that surely have no label are not measured; the others travel as measures, without their texts.
    likely = sifted(
        docs.select(F.col(quoted(doc_id)).alias("id"), F.col(quoted(text)).alias("text")).where("id IS NOT NULL"),
        F.col("id"), stored(sieve(chosen, F.col("l_id")), "quality-sieve"), "labelled",
    ).where("labelled")
    rows = stored(
        likely.select("id", measures(F.col("text")).alias("x"))
        .join(chosen, F.col("id") == F.col("l_id"))
        .select("y", *[F.col("x")[m].alias(m) for m in MEASURES]),
        "quality-measures",
    )
    found = rows.agg(
        F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0),
        *[f(F.col(m)) for f in (F.mean, F.stddev_pop, F.min, F.max) for m in MEASURES],
    ).first()
    good, poor = found[:2]
    if not good or not poor:
        return Ranking(None)
    mean, scale, low, high = np.array(found[2:], dtype=float).reshape(4, len(MEASURES))
    mean, scale = shortened(mean), shortened(scale)
    scale[scale == 0] = 1
    sums = [f"s{i}" for i in range(1 + len(MEASURES) + len(MEASURES) * (len(MEASURES) + 1) // 2)]

    def gather(w: np.ndarray, start: float, width: float) -> tuple[np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = np.column_stack([batch.column(m).to_numpy() for m in MEASURES])
                    place, added = tallied((x - mean) / scale, batch.column("y").to_numpy(), w, start, width)
                    yield pa.RecordBatch.from_arrays([pa.array(place), *map(pa.array, added.T)], ["place", *sums])

        parts = rows.mapInArrow(run, "place bigint, " + ", ".join(f"{c} double" for c in sums))
        got = parts.groupBy("place").agg(*[F.sum(c).alias(c) for c in sums]).toPandas().sort_values("place")
        return got["place"].to_numpy(), got[sums].to_numpy(dtype=float)

    weights = fitted(gather, (low - mean) / scale, (high - mean) / scale) / scale
    strengths = rows.select(sum((F.lit(float(w)) * F.col(m) for w, m in zip(weights, MEASURES)), F.lit(0.0)).alias("s"))
    below, above = neighbours(strengths, poor)
    return Ranking(tuple(float(w) for w in weights), (below + above) / 2)


def rank(x: np.ndarray, y: np.ndarray) -> Ranking:
    """The same from arrays: weights from all pairs of a good and a poor row, and the cut at the quantile of poor rows."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1
    z = (x - mean) / scale
    weights = fitted(lambda *at: tallied(z, y, *at), z.min(axis=0), z.max(axis=0)) / scale
    strength = np.sort(x @ weights)
    at = int((y == 0).sum())  # so many of the strengths lie below the cut
    return Ranking(tuple(float(w) for w in weights), float((strength[at - 1] + strength[at]) / 2))


def shortened(values: np.ndarray) -> np.ndarray:
    """Without the last digits, in which sums of the same terms may differ."""
    return np.array([float(f"{v:.12g}") for v in values])


def tallied(z: np.ndarray, y: np.ndarray, w: np.ndarray, start: float, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows by place, 2 * interval of strength + y: their number, summed measures and summed products of measures."""
    place = 2 * np.clip((z @ w - start) // width, 0, BINS - 1).astype(np.int64) + y
    order = np.argsort(place, kind="stable")
    place, z = place[order], z[order]
    first = np.flatnonzero(np.diff(place, prepend=-1))
    i, j = np.triu_indices(z.shape[1])
    return place[first], np.add.reduceat(np.column_stack([np.ones(len(z)), z, z[:, i] * z[:, j]]), first)


def fitted(
    gather: Callable[[np.ndarray, float, float], tuple[np.ndarray, np.ndarray]],
    low: np.ndarray, high: np.ndarray, ridge: float = 1e-2,
) -> np.ndarray:
    """Weights of standardised measures by Newton steps, with strengths of a spread of 4.

    `gather` gives `tallied` of all rows; `low` and `high` bound the measures.
    """
    k = len(low)
    i, j = np.triu_indices(k)
    w = np.zeros(k)

    def split(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        square = np.zeros((len(sums), k, k))
        square[:, i, j] = square[:, j, i] = sums[:, 1 + k :]
        return sums[:, 0], sums[:, 1 : 1 + k], square

    for _ in range(25):
        start, end = np.minimum(w * low, w * high).sum(), np.maximum(w * low, w * high).sum()
        place, sums = gather(w, float(start), float(max(end - start, 1e-9) / BINS))
        n, x, xx = split(sums[place % 2 == 1])
        n0, x0, xx0 = split(sums[place % 2 == 0])
        pairs = n.sum() * n0.sum()
        # Every good interval against every poor one: the chance that the good row loses.
        lost = 1 / (1 + np.exp(np.clip((x @ w / n)[:, None] - (x0 @ w / n0)[None, :], -30, 30)))
        slope = (x.T @ (lost @ n0) - x0.T @ (lost.T @ n)) / pairs - ridge * w
        bent = lost * (1 - lost)
        cross = x.T @ bent @ x0
        squares = np.tensordot(bent @ n0, xx, 1) + np.tensordot(bent.T @ n, xx0, 1)
        step = np.linalg.solve((squares - cross - cross.T) / pairs + ridge * np.eye(k), slope)
        w = shortened(w + step)
        if np.abs(step).max() < 1e-3:  # the next would be of the order of its square, below what the intervals resolve
            break
    # Unit spread: scores are comparable between fits.
    number, mean = n.sum() + n0.sum(), (x.sum(axis=0) + x0.sum(axis=0))
    spread = w @ ((xx.sum(axis=0) + xx0.sum(axis=0)) / number - np.outer(mean, mean) / number**2) @ w
    return shortened(w / (max(float(np.sqrt(max(spread, 0.0))), 1e-9) / 4))


def neighbours(values: DataFrame, place: int) -> tuple[float, float]:
    """The values at `place` (from 1) and `place` + 1 of column `s` in ascending order, exactly; there are that many rows."""
    low, high = values.agg(F.min("s"), F.max("s")).first()
    before = 0
    while low < high:
        inside = values.where(F.col("s").between(low, high))
        bin_ = F.least(F.floor((F.col("s") - low) / ((high - low) / BINS)), F.lit(BINS - 1))
        bins = inside.groupBy(bin_.alias("bin")).agg(F.count("s").alias("n"), F.min("s").alias("low"), F.max("s").alias("high"))
        for b in sorted(bins.collect(), key=lambda b: b.bin):
            low, high = b.low, b.high
            if before + b.n >= place:
                break
            before += b.n
    upto, after = values.agg(F.count_if(F.col("s") <= low), F.min(F.when(F.col("s") > low, F.col("s")))).first()
    return low, low if upto > place else after


def scored(docs: DataFrame, ranking: Ranking, text: str = "text") -> DataFrame:
    """`docs` as a struct `row`, with score and predicted (1: good)."""
    score = ranking.score(measures(F.col(quoted(text))))
    return docs.select(row_of(docs).alias("row"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= GOOD).cast("int")
    )


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of `docs` that score as good, with its columns."""
    return scored(docs, fit(docs, labels, text, doc_id), text).where("predicted = 1").select("row.*")
