"""Stupid backoff against counting in a dictionary."""

import math
import random
import re
from collections import Counter

import pytest

from tierflow.llm import bundles
from tierflow.llm.backoff import DISCOUNT, backoff_scores
from tierflow.llm.queries import op6_backoff_score
from tierflow.llm.shared import stored

SCHEMA = "doc_id bigint, text string, unit int, blob string"


def brute(texts, order, least, leave_out=False):
    """Words, sum of logs and words that backed off of each text, by counting in dictionaries."""
    docs = [re.findall(r"[^\x20\x09-\x0d]+", t or "") for t in texts]
    count = lambda d: Counter(tuple(d[i : i + n]) for n in range(1, order + 1) for i in range(len(d) - n + 1))
    counts, total = Counter(), sum(map(len, docs))
    for d in docs:
        counts.update(count(d))

    def score(d, i, own, left):
        for back in range(min(order - 1, i), 0, -1):
            run = tuple(d[i - back : i + 1])
            if counts[run] - own[run] >= least:
                ratio = (counts[run] - own[run]) / (counts[run[:-1]] - own[run[:-1]])
                return math.log(ratio) + (min(order - 1, i) - back) * math.log(DISCOUNT), back < min(order - 1, i)
        n = counts[d[i],] - own[d[i],]
        return math.log((n or DISCOUNT) / max(left, 1)) + min(order - 1, i) * math.log(DISCOUNT), i > 0 and order > 1

    out = []
    for d in docs:
        own = count(d) if leave_out else Counter()
        scores = [score(d, i, own, total - len(d) * leave_out) for i in range(len(d))]
        out.append((len(d), sum(s for s, _ in scores), sum(b for _, b in scores)))
    return out


def texts():
    draw = random.Random(4)
    out = [" ".join(draw.choice("the of and a é word other".split() + [f"x{i}" for i in range(60)]) for _ in range(draw.randint(0, 80)))
           for _ in range(120)]
    return out + [out[3], out[3], None, "", " \n", "the", "\x1cthe \x85", "the of\tand\x0bthe", "very long " * 20_000]


@pytest.mark.parametrize("order, leave_out", [(1, False), (2, False), (3, False), (1, True), (3, True)])
def test_scores_equal_brute_force(spark, monkeypatch, order, leave_out):
    monkeypatch.setattr(bundles, "BUNDLE_BYTES", 3000)
    rows = [(i if i % 10 else None, t, 1, "b") for i, t in enumerate(texts())]
    got = backoff_scores(spark.createDataFrame(rows, SCHEMA), order=order, leave_out=leave_out).collect()
    want = brute(texts(), order, 2, leave_out)
    key = lambda r: (str(r[0]), r[1], r[2])
    ours = sorted(((r.doc_id, r.n_words, r.log_score, r.n_backed_off) for r in got), key=key)
    theirs = sorted(((r[0], *w) for r, w in zip(rows, want)), key=key)
    assert [o[:2] for o in ours] == [t[:2] for t in theirs]
    assert [o[2] for o in ours] == pytest.approx([t[2] for t in theirs], rel=1e-9, abs=1e-9)
    assert [o[3] for o in ours] == [t[3] for t in theirs] and (order == 1 or sum(t[3] for t in theirs) > 100)
    assert all((r.mean_log_score is None) == (r.n_words == 0) for r in got)


def test_empty_table(spark):
    assert backoff_scores(spark.createDataFrame([], SCHEMA)).collect() == []


def test_the_registered_query_scores_by_the_other_documents(spark, area):
    rows = [(i, t) for i, t in enumerate(texts()[:-1])] + [(900, "alone in saying this"), (901, "said by two of them"), (902, "said by two of them")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{area}/documents.parquet")
    got = {r.doc_id: r for r in op6_backoff_score(spark, area).collect()}
    want = brute([t for _, t in rows], 3, 1, leave_out=True)
    assert [(got[i].n_words, got[i].n_backed_off) for i, _ in rows] == [(w[0], w[2]) for w in want]
    assert [got[i].log_score for i, _ in rows] == pytest.approx([w[1] for w in want], rel=1e-9, abs=1e-9)
    assert got[900].n_backed_off == 3 and got[901].n_backed_off == 0 and got[901].mean_log_score > got[900].mean_log_score + 3


def test_what_was_shuffled_for_a_stored_table_is_removed(spark, area):
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {str(f) for f in local.getAllFiles().mkString("\n").split("\n") if "shuffle" in f}
    before = files()
    stored(spark.range(1000).repartition(7, "id"), "release")
    assert files() <= before
