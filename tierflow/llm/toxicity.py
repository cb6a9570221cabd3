"""Toxic texts: a lexicon learned from labels, matched with spelling errors, weighed by its surroundings.

The lexicon holds the words that labelled toxic texts have far more often than labelled clean ones; a word counts once
per neighbour, so that copies of one text prove nothing. Its trie is intersected with the Levenshtein automaton of
distance one: a state is the set of (trie node, errors) reachable by the letters so far, built when first met and kept,
so most words leave the automaton after two or three letters. A hit weighs its term's strength, more if the text around
it addresses someone and less if it is quoted or reported. What hits amount to is calibrated on labelled rows that took
no part in the lexicon, together with the length of the text.

Only the bounded sample of labelled rows (`SAMPLE`), its word counts and the lexicon (`TERMS`) leave the executors.
Scoring is one pass over whole texts, without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.shared import quoted, row_of, stored
from tierflow.llm.words import portions

#: At most so many labelled rows teach, those with the least hash of their id.
SAMPLE = 20_000
#: At most so many terms, the strongest.
TERMS = 5_000
#: A term is in the lexicon from this many neighbours and this log odds on.
NEIGHBOURS, STRENGTH = 3, 2.5
#: Shorter terms must be spelled right.
FUZZY_FROM = 5
#: A text is toxic from this score on.
TOXIC = 0.7
WINDOW = 4
#: Factors of a hit that is quoted or reported, and of one that addresses someone.
QUOTED, ADDRESSED = 0.25, 1.5
REPORTING = frozenset("said says say wrote writes called calls quote quoted quotes term word slur dit sagte dijo".split())
ADDRESS = frozenset("you your youre u ur du dich dein ihr tu te toi vous tú usted".split())
WORD = re.compile(r"[^\W_]+")


class FuzzyLexicon:
    """Looks words up in a set of terms with at most one insertion, deletion or substitution."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        for term in terms:
            node = 0
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                node = self.children[node][letter]
            self.term[node] = term
        self.number: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.start = self._state({(0, 0)})
        self.known: dict[str, tuple[str, int] | None] = {}

    def _state(self, spots: set[tuple[int, int]]) -> int:
        """The state of these (node, errors), with letters that the word may lack; -1 if there is none."""
        spots = spots | {(child, 1) for node, errors in spots if not errors for child in self.children[node].values()}
        state = frozenset(s for s in spots if not s[1] or (s[0], 0) not in spots)
        if not state:
            return -1
        if state not in self.number:
            self.number[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
        return self.number[state]

    def _step(self, state: int, letter: str) -> int:
        spots = set()
        for node, errors in self.states[state]:
            if letter in self.children[node]:
                spots.add((self.children[node][letter], errors))
            if not errors:
                spots.add((node, 1))
                spots.update((child, 1) for child in self.children[node].values())
        self.steps[state][letter] = to = self._state(spots)
        return to

    def find(self, word: str) -> tuple[str, int] | None:
        """The term that `word` is, or is meant to be, and the number of errors; the first of equally near ones."""
        if word in self.known:
            return self.known[word]
        state = self.start
        for letter in word:
            to = self.steps[state].get(letter)
            state = self._step(state, letter) if to is None else to
            if state < 0:
                break
        best = None
        if state >= 0:
            ends = [
                (errors, self.term[node])
                for node, errors in self.states[state]
                if self.term[node] and (not errors or len(self.term[node]) >= FUZZY_FROM)
            ]
            if ends:
                errors, term = min(ends)
                best = (term, errors)
        if len(self.known) > 500_000:
            self.known.clear()
        self.known[word] = best
        return best


@dataclass
class Judge:
    """Everything a task needs to score: the lexicon, words that only look like a term, and the calibration."""

    strength: dict[str, float]
    ordinary: frozenset = frozenset()
    weights: tuple[float, ...] | None = None
    bias: float = 0.0
    _lexicon: FuzzyLexicon | None = field(default=None, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_lexicon": None}

    def hits(self, text: str) -> tuple[list[tuple[str, str, int, float]], int]:
        """(word, term, errors, factor by context) of each hit, and the number of words."""
        if self._lexicon is None:
            self._lexicon = FuzzyLexicon(sorted(self.strength))
        folded = text.lower()
        words = WORD.findall(folded)
        meant = {}
        for word in set(words):
            found = self._lexicon.find(word)
            if found and not (found[1] and word in self.ordinary):
                meant[word] = found
        if not meant:
            return [], len(words)
        out = []
        for k, spot in enumerate(WORD.finditer(folded)):
            if spot[0] in meant:
                near = words[max(0, k - WINDOW) : k] + words[k + 1 : k + 1 + WINDOW]
                factor = 1.0
                if in_quotes(folded, spot.start(), spot.end()) or not REPORTING.isdisjoint(near):
                    factor = QUOTED
                elif not ADDRESS.isdisjoint(near):
                    factor = ADDRESSED
                out.append((spot[0], *meant[spot[0]], factor))
        return out, len(words)

    def evidence(self, text: str | None) -> tuple[float, float, float]:
        """Evidence by terms spelled right, by misspelled ones, and the length of the text, each on a log scale."""
        hits, count = self.hits(text or "")
        exact = sum(self.strength[term] * factor for _, term, errors, factor in hits if not errors)
        fuzzy = sum(self.strength[term] * factor for _, term, errors, factor in hits if errors)
        return math.log1p(exact), math.log1p(fuzzy), math.log1p(count)

    def score(self, text: str | None) -> float:
        if self.weights is None:
            return 0.0
        value = self.bias + sum(w * x for w, x in zip(self.weights, self.evidence(text)))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, value))))


def in_quotes(text: str, start: int, end: int, reach: int = 200) -> bool:
    """Whether the nearest quotation mark before opens and one follows in the same line."""
    left, right = text[max(0, start - reach) : start].rpartition("\n")[2], text[end : end + reach].partition("\n")[0]
    if left.count('"') % 2 and '"' in right:
        return True
    opened = max(left.rfind(c) for c in "“«„‘")
    closed = max(left.rfind(c) for c in "”»’")
    return opened > closed and any(c in right for c in "”»“’")


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic") -> Judge:
    """Lexicon and calibration from the rows in `labels` (id, 0/1); leave held-out rows out of it beforehand.

    Null ids and labels teach nothing. Without both labels, or without a term, nothing is toxic.
    """
    chosen = (
        labels.select(F.col(quoted(doc_id)).alias("l_id"), F.col(quoted(label)).cast("int").alias("y"))
        .where("l_id IS NOT NULL AND y IN (0, 1)")
        .orderBy(F.xxhash64("l_id"), "l_id", "y")
        .limit(SAMPLE)
    )
    sample = stored(
        docs.select(F.col(quoted(doc_id)).alias("id"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"))
        .join(F.broadcast(chosen), F.col("id") == F.col("l_id"))
        .select("text", "y", F.pmod(F.xxhash64("text", F.lit(1)), F.lit(3)).alias("part"))
        .dropDuplicates(["text", "y"]),
        "toxic-sample",
    )
    teach, check = sample.where("part < 2"), sample.where("part = 2")
    totals = {r["y"]: r["count"] for r in teach.groupBy("y").count().collect()}
    if len(totals) < 2:
        return Judge({})
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    pairs = teach.select("y", F.monotonically_increasing_id().alias("nr"), words.alias("w")).select(
        "y", "nr", F.explode(F.arrays_zip(F.col("w").alias("word"), F.concat(F.array(F.lit("")), "w").alias("left"))).alias("p")
    ).select("y", "nr", "p.word", "p.left").where("word IS NOT NULL")
    toxic, clean = F.col("y") == 1, F.col("y") == 0
    counted = pairs.groupBy("word").agg(
        F.count_distinct(F.when(toxic, F.col("nr"))).alias("t"),
        F.count_distinct(F.when(clean, F.col("nr"))).alias("c"),
        F.count_distinct(F.when(toxic, F.col("left"))).alias("neighbours"),
    )
    odds = F.log((F.col("t") + 0.5) / (totals[1] + 1)) - F.log((F.col("c") + 0.5) / (totals[0] + 1))
    terms = (
        counted.withColumn("strength", odds)
        .where((F.col("neighbours") >= NEIGHBOURS) & (F.col("strength") >= STRENGTH))
        .orderBy(F.desc("strength"), "word")
        .limit(TERMS)
        .collect()
    )
    strength = {r["word"]: float(r["strength"]) for r in terms}
    if not strength:
        return Judge({})
    return calibrate(Judge(strength), sample, check)


def calibrate(judge: Judge, sample: DataFrame, check: DataFrame) -> Judge:
    """Find misspellings that are ordinary words in clean rows, then weigh the evidence on rows the lexicon has not seen."""

    def lookalikes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {w for t in batch.column("text").to_pylist() for w, _, errors, _ in judge.hits(t)[0] if errors}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["word"])

    clean = sample.where("y = 0").select("text").mapInArrow(lookalikes, "word string").distinct().collect()
    judge = Judge(judge.strength, frozenset(r["word"] for r in clean))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge.evidence(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array([r[k] for r in rows], pa.float64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("y"), *columns], ["y", "exact", "fuzzy", "length"])

    rows = check.select("text", "y").mapInArrow(measured, "y int, exact double, fuzzy double, length double").toPandas()
    rows = rows.sort_values(list(rows.columns))
    y, x = rows["y"].to_numpy(), rows[["exact", "fuzzy", "length"]].to_numpy()
    if len(y) == 0 or y.min() == y.max():
        # Too few rows to calibrate on: two strong terms make a text toxic.
        least = math.log1p(1.5 * STRENGTH)
        return Judge(judge.strength, judge.ordinary, (4.0, 2.0, 0.0), math.log(TOXIC / (1 - TOXIC)) - 4.0 * least)
    weights, cut = logistic(x, y)
    return Judge(judge.strength, judge.ordinary, tuple(weights), math.log(TOXIC / (1 - TOXIC)) - cut)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.02) -> tuple[np.ndarray, float]:
    """Weights, those of evidence not negative, and the cut with the fewest errors, amid the gap around it."""
    z = np.column_stack([x, np.ones(len(x))])
    penalty = ridge * np.diag([1.0] * x.shape[1] + [1e-3])
    # Both kinds weigh the same.
    row = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    use = np.ones(z.shape[1], dtype=bool)
    while True:
        w = np.zeros(z.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            slope = (z.T @ (row * (y - p)) / len(y) - penalty @ w)[use]
            bend = ((z * (row * p * (1 - p))[:, None]).T @ z / len(y) + penalty)[np.ix_(use, use)]
            step = np.linalg.solve(bend, slope)
            w[use] += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-9:
                break
        against = [k for k in (0, 1) if w[k] < 0]
        if not against:
            break
        use[against] = False
    value = x @ w[:-1]
    order = np.argsort(value, kind="stable")
    value, y = value[order], y[order]
    wrong = np.concatenate([[0], np.cumsum(y == 1)]) + np.concatenate([np.cumsum((y == 0)[::-1])[::-1], [0]])
    best = np.flatnonzero(wrong == wrong.min())
    middle = int(best[len(best) // 2])
    low = value[middle - 1] if middle else value[0] - 1
    high = value[middle] if middle < len(value) else value[-1] + 1
    return w[:-1], float((low + high) / 2)


def scored(docs: DataFrame, judge: Judge, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """`columns` of `docs` (all by default) as a struct `row`, with score and predicted (1: toxic). Null counts as empty."""
    wanted = docs.select(*[F.col(quoted(c)) for c in (docs.columns if columns is None else columns)])
    rows = docs.select(row_of(wanted).alias("row"), F.col(quoted(text)).alias("text"))
    schema = rows.select("row").schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, "text"):
                score = pa.array([judge.score(t) for t in part.column("text").to_pylist()], pa.float64())
                yield pa.RecordBatch.from_arrays([part.column("row"), score], ["row", "score"])

    return rows.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))
