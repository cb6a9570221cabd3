"""Repeated passages against a dictionary of all windows, and the index against plain search."""

import random
import re
from hashlib import sha256

import numpy as np
import pytest

from tierflow.llm import bundles
from tierflow.llm.fm_index import FMIndex
from tierflow.llm.substrings import earliest_ids, passages

SCHEMA = "doc_id bigint, text string, unit bigint, removed int"


def brute(rows, window):
    docs = [(i, re.findall(r"[^\x20\x09-\x0d]+", t or "")) for i, t in rows]
    late = lambda i: (i is None, i or 0)
    first = {}
    for i, words in docs:
        for k in range(len(words) - window + 1):
            run = tuple(words[k : k + window])
            first[run] = min(first.get(run, (True, 0)), late(i))
    out = []
    for i, words in docs:
        gone = set()
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] < late(i):
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    draw = random.Random(seed)
    prose = lambda n: [draw.choice("the of and a é".split() + [f"x{i}" for i in range(12)]) for _ in range(n)]
    common = [prose(n) for n in (12, 13, 14, 30, 80)]
    texts = []
    for _ in range(90):
        parts = [prose(draw.randint(0, 30))]
        for _ in range(draw.randint(0, 3)):
            parts += [draw.choice(common), prose(draw.randint(0, 9))]
        texts.append(draw.choice([" ", "\n", "  \t"]).join(" ".join(p) for p in parts))
    texts += [texts[5], texts[5], None, "", "\t", "again " * 400, "again " * 500, "one", " ".join(common[3])]
    ids = list(range(len(texts)))
    draw.shuffle(ids)
    return [(None if i in (3, 4, 9) else i, t) for i, t in zip(ids, texts)]


@pytest.mark.parametrize("window,bundle", [(13, 2000), (13, 1 << 20), (4, 2000), (1, 500)])
def test_removed_words_equal_brute_force(spark, monkeypatch, window, bundle):
    monkeypatch.setattr(bundles, "BUNDLE_BYTES", bundle)
    rows = corpus(window)
    rows += [rows[0], (rows[1][0], rows[2][1])]  # a repeated row, and an id with two texts
    df = spark.createDataFrame([(i, t, 1, 1) for i, t in rows], SCHEMA)
    got = passages(df, window=window).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=repr) == brute(rows, window)
    assert all(sum(s.end - s.start for s in r.removed) == r.n_removed for r in got)


def test_empty_table(spark):
    assert passages(spark.createDataFrame([], SCHEMA)).collect() == []


def test_backward_search_finds_the_interval_of_every_pattern():
    draw = np.random.default_rng(2)
    pieces = [draw.integers(1, 5, draw.integers(1, 40)) for _ in range(30)]
    text = np.concatenate([np.append(p, 0) for p in pieces])
    index = FMIndex(text, 5)
    assert sorted(index.suffixes) == list(range(len(text)))
    ends = np.append(index.block_start, len(text))
    for start in [i for i in range(len(text) - 7) if (text[i : i + 7] > 0).all()]:
        low = np.array([0])
        for length in range(1, 8):
            low = index.extend(text[[start + 7 - length]], low)
            run = tuple(text[start + 7 - length : start + 7])[:5]
            rows = [k for k, i in enumerate(index.suffixes) if tuple(text[i : i + len(run)]) == run]
            if length <= 5:
                assert low[0] == rows[0]
            else:  # cut back to the block of its first five symbols
                block = index.block[low[0]]
                low = index.block_start[[block]]
                assert rows == list(range(low[0], ends[block + 1]))


def test_windows_of_segments_have_their_smallest_id():
    draw = np.random.default_rng(4)
    lengths = draw.integers(3, 300, 80)
    lengths[:20] = lengths[0]
    words = draw.integers(1, 3, lengths.sum()).astype(np.uint64) << np.uint64(60)
    words[: 20 * lengths[0]] = np.tile(words[: lengths[0]], 20)
    ids = draw.permutation(80)
    ends = np.cumsum(lengths)
    first = {}
    runs = [(k, tuple(words[i : i + 3])) for k, (n, e) in enumerate(zip(lengths, ends)) for i in range(e - n, e - 2)]
    for k, run in runs:
        first[run] = min(first.get(run, 99), ids[k])
    assert earliest_ids(words, lengths, ids, 3).tolist() == [first[run] for _, run in runs]
