"""Toxicity: the automaton against edit distances, held-out accuracy, context and odd input."""

import math
import random

from tierflow.llm.queries import QUERIES
from tierflow.llm.toxicity import ADDRESSED, FUZZY_FROM, QUOTED, FuzzyLexicon, Judge, learn, scored

ROOT = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, score string, row int"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, before[j] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_automaton_finds_what_edit_distance_finds():
    draw = random.Random(5)
    word = lambda n: "".join(draw.choice("abc") for _ in range(n))
    terms = sorted({word(draw.randint(1, 8)) for _ in range(60)})
    lexicon = FuzzyLexicon(terms)
    for _ in range(3000):
        text = word(draw.randint(1, 9))
        near = [(d, t) for t in terms if (d := distance(text, t)) == 0 or d == 1 and len(t) >= FUZZY_FROM]
        assert lexicon.find(text) == ((min(near)[1], min(near)[0]) if near else None)


def test_context_separates_quotation_from_abuse():
    judge = Judge({"moron": 5.0, "rotten": 4.0}, frozenset({"rotter"}))
    factor = lambda text: [h[3] for h in judge.hits(text)[0]]
    assert factor("what a moron indeed") == [1.0]
    assert factor("you are a moron") == [ADDRESSED]
    assert factor('she answered "moron" and left') == factor("he said moron again") == factor("le mot «moron» ici") == [QUOTED]
    assert [h[:3] for h in judge.hits("MORRON rottn rotter")[0]] == [("morron", "moron", 1), ("rottn", "rotten", 1)]
    assert judge.evidence(None) == judge.evidence("") == (0.0, 0.0, 0.0)


def test_held_out_accuracy(spark):
    got = QUERIES["op8_toxicity"](spark, ROOT).cache()
    assert got.count() == spark.read.parquet(f"{ROOT}/documents.parquet").count()
    rows = got.where("held_out").join(spark.read.parquet(f"{ROOT}/labels.parquet"), "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in rows) > 0.92 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.collect())


def test_learning_and_odd_input(spark):
    draw = random.Random(2)
    prose = lambda n: " ".join(draw.choice("abcdefghij") * 3 + draw.choice("kl") for _ in range(n))
    docs = [(i, prose(30), "s", 1) for i in range(300)]
    docs += [(1000 + i, f"{prose(10)} vermin {prose(9)} vermin {prose(3)}", "s", 1) for i in range(100)]
    docs += [(None, None, None, None), (2000, "", "s", 1), (2001, "word " * 60_000, "s", 1), (2002, f"{prose(9)} vermim {prose(4)} vermn", "s", 1)]
    df = spark.createDataFrame(docs, SCHEMA)
    labels = spark.createDataFrame([(i, int(i >= 1000)) for i, *_ in docs[:380]] + [(None, 1), (5, None), (7777, 1)],
                                   "doc_id bigint, toxic int")
    judge = learn(df, labels)
    assert set(judge.strength) == {"vermin"}
    got = {r.row.doc_id: r.predicted for r in scored(df, judge).collect()}
    assert all(got[i] == 0 for i in [*range(300), None, 2000, 2001]) and all(got[1000 + i] for i in range(100))
    assert scored(df, judge).select("row.*").columns == df.columns
    for none in (learn(df, labels.where("toxic = 0")), learn(df, labels.limit(0)), learn(df.limit(0), labels)):
        assert not none.strength and {r.predicted for r in scored(df, none).collect()} == {0}
    assert scored(df.limit(0), judge).collect() == []
    assert math.isclose(judge.score(None), judge.score(""))
