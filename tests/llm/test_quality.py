"""Quality ranking: held-out accuracy and odd input."""

import re

import numpy as np
import regex
from pyspark.sql import functions as F

from tierflow.llm.quality import MEASURES, neighbours
from tierflow.llm.quality import RIVALS, Ranking, fit, keep_good, measures, rank, scored
from tierflow.llm.queries import QUERIES
from tierflow.llm.words import mixed

ROOT = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, score string, x int"


def test_held_out_accuracy(spark):
    got = QUERIES["op2_quality_classifier"](spark, ROOT)
    assert got.count() == spark.read.parquet(f"{ROOT}/documents.parquet").count()
    pairs = got.where("held_out").join(spark.read.parquet(f"{ROOT}/labels.parquet"), "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in pairs]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.collect())


def test_odd_texts_and_labels(spark):
    docs = [(i, "A fine short sentence of words, number %d." % i, "s", 1) for i in range(40)]
    docs += [(100 + i, "BAD!! " * (3 + i), "s", 1) for i in range(20)] + [(None, None, None, None), (200, "", "s", 1),
                                                                      (201, "long " * 50_000, "s", 1)]
    df = spark.createDataFrame(docs, SCHEMA)
    labels = spark.createDataFrame(
        [(i, 1) for i in range(30)] + [(100 + i, 0) for i in range(15)] + [(None, 1), (5, None), (999, 0), (3, 1)],
        "doc_id bigint, quality int",
    )
    ranking = fit(df, labels)
    got = {r.row.doc_id: r for r in scored(df, ranking).collect()}
    assert len(got) == len(docs)
    assert all(got[i].predicted == 1 for i in range(40)) and all(got[100 + i].predicted == 0 for i in range(20))
    assert keep_good(df, labels).columns == df.columns
    assert scored(df.limit(0), ranking).collect() == []
    assert fit(df, labels.where("quality = 1")) == Ranking(None) == fit(df, labels.limit(0)) == fit(df.limit(0), labels)
    assert keep_good(df, labels.limit(0)).count() == len(docs)


def test_measures_of_empty_and_null_text_are_finite(spark):
    texts = spark.createDataFrame([(None,), ("",), (" \n\t",), ("a",)], "text string")
    for r in texts.select(measures(F.col("text")).alias("m")).collect():
        assert all(np.isfinite(v) for v in r.m)


def test_rank_orders_pairs_and_cuts_at_the_share_of_poor_rows():
    draw = np.random.default_rng(1)
    x = np.concatenate([draw.normal(0, 1, (300, 3)), draw.normal(3, 1, (100, 3))])
    y = np.array([1] * 300 + [0] * 100)
    r = rank(x, y)
    strength = x @ np.array(r.weights) - r.cut
    assert (strength < 0).sum() == 100 and ((strength >= 0) == y).mean() > 0.97


def test_pairs_take_in_all_good_rows_whatever_their_number():
    for n_good in (7, 97, 7919):
        drawn = mixed(np.arange(1, 2_000 * RIVALS + 1, dtype=np.uint64)) % np.uint64(n_good)
        counts = np.bincount(drawn.astype(int), minlength=n_good)
        assert (counts > 0).mean() > 0.85 and counts.max() < 10 + 3 * counts.mean()


def plain_fit(x, y):
    """Bradley-Terry by gradient ascent over all pairs of a good and a poor row."""
    z = x / x.std(axis=0)
    apart = (z[y == 1][:, None, :] - z[y == 0][None, :, :]).reshape(-1, x.shape[1])
    w = np.zeros(x.shape[1])
    for _ in range(3_000):
        w += 0.5 * (apart.T @ (1 / (1 + np.exp(apart @ w))) / len(apart) - 1e-2 * w)
    return w / x.std(axis=0)


def test_weights_come_near_those_of_all_pairs():
    draw = np.random.default_rng(3)
    x = np.concatenate([draw.normal(0, 1, (120, 3)), draw.normal((1.0, 0.3, -0.5), 1, (90, 3))])
    y = np.array([1] * 120 + [0] * 90)
    got, want = np.array(rank(x, y).weights), plain_fit(x, y)
    assert got @ want / np.linalg.norm(got) / np.linalg.norm(want) > 0.99
    order = np.argsort(x @ got)
    assert np.corrcoef(np.argsort(order), np.argsort(np.argsort(x @ want)))[0, 1] > 0.99


def test_scores_equal_a_restatement_in_python(spark):
    """Measures and score of every text of a table, by plain Python."""
    docs = spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id", "text")
    ranking = fit(docs, spark.read.parquet(f"{ROOT}/labels.parquet"))
    for r in scored(docs, ranking).collect():
        text = r.row.text or ""
        words, lines = re.findall(r"[^\x20\x09-\x0D]+", text), [s for s in text.split("\n") if s]
        size, count = max(len(text), 1), len(words)
        share = lambda pattern: sum(map(len, regex.findall(pattern, text))) / size
        values = [
            share(r"[^\p{L}\p{N}\x20\x09-\x0D.,;:'\"()?-]") ** 0.5, share(r"\p{Lu}") ** 0.5,
            np.log1p(len(set(words))) / np.log1p(count) if count > 1 else 1.0,
            (sum(a == b for a, b in zip(words, words[1:])) / max(count, 1)) ** 0.5,
            np.log1p(min(size / max(count, 1), 200)), share("[0-9]") ** 0.5,
            1 - len(set(lines)) / len(lines) if len(lines) > 1 else 0.0, share("[.,;:]") ** 0.5, np.log1p(count),
        ]
        want = 1 / (1 + np.exp(-(np.dot(values, ranking.weights) - ranking.cut + np.log(0.7 / 0.3))))
        assert abs(r.score - want) < 1e-6, (r.row.doc_id, r.score, want)


def test_weights_equal_those_of_all_pairs():
    draw = np.random.default_rng(5)
    x = np.concatenate([draw.normal(0, 1, (150, 3)), draw.normal((0.8, 0.2, -0.4), 1, (90, 3))])
    y = np.array([1] * 150 + [0] * 90)
    got, want = np.array(rank(x, y).weights), plain_fit(x, y)
    want *= 4 / (x @ want).std()
    assert np.abs(got - want).max() < 1e-3


def test_every_labelled_row_teaches(spark):
    """More labelled rows than the 20,000 that used to be drawn: weights and cut are those of all of them."""
    texts = F.concat(
        F.expr("repeat('plain words. ', int(1 + pmod(xxhash64(id), 5)))"),
        F.when(F.expr("pmod(xxhash64(id, 1), 10) < 4"), F.expr("repeat('!%', int(1 + pmod(xxhash64(id, 2), 7)))")).otherwise(""),
    )
    docs = spark.range(30_000, numPartitions=4).select(F.col("id").alias("doc_id"), texts.alias("text"))
    labels = docs.select("doc_id", F.expr("int(pmod(xxhash64(doc_id, 1), 10) >= 4 OR pmod(xxhash64(doc_id, 3), 9) = 0)").alias("quality"))
    rows = docs.join(labels, "doc_id").select("quality", measures(F.col("text")).alias("m")).select("quality", "m.*").toPandas()
    x, y = rows[list(MEASURES)].to_numpy(), rows["quality"].to_numpy()
    got, want = fit(docs, labels), rank(x, y)
    assert np.abs(np.array(got.weights) - want.weights).max() < 1e-6 * np.abs(want.weights).max()
    assert abs(got.cut - want.cut) < 1e-6 and got.cut == fit(docs.repartition(3), labels.repartition(5)).cut


def test_neighbours_are_the_values_at_their_places(spark):
    draw = np.random.default_rng(2)
    values = np.concatenate([draw.normal(0, 1, 3_000), [0.25] * 700, [1e9, -1e-300, 5e-324]]).tolist()
    df = spark.createDataFrame([(v,) for v in values], "s double").repartition(3).cache()
    values.sort()
    for place in (1, 2, 1_500, 1_900, 2_100, len(values) - 1):
        assert neighbours(df, place) == (values[place - 1], values[place])
