"""Greedy string tiling against a plain restatement."""

import random
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pytest

from tierflow.llm import decontaminate
from tierflow.llm.decontaminate import contaminated, drop_contaminated, tiles

DOCS = "doc_id bigint, text string, item_id string, tiles int"
ITEMS = "item_id bigint, text string, doc_id int"


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def plain_tiles(a, b, least=5):
    """Marked tokens of `a`, taking the longest unmarked common run again and again."""
    marked_a, marked_b = set(), set()
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while (i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and i + k not in marked_a
                       and j + k not in marked_b):
                    k += 1
                best = max(best, (k, -i, -j))
        k, i, j = best[0], -best[1], -best[2]
        if k < least:
            return len(marked_a)
        marked_a.update(range(i, i + k))
        marked_b.update(range(j, j + k))


def case(seed):
    draw = random.Random(seed)
    items = [[draw.choice("abcdefgh") * 2 for _ in range(draw.randint(3, 30))] for _ in range(6)]
    docs = []
    for _ in range(25):
        text = [draw.choice("ijklmnop") for _ in range(draw.randint(0, 20))]
        for _ in range(draw.randint(0, 2)):
            item = draw.choice(items)
            cut = draw.randint(0, len(item))
            part = item[cut:] + item[:cut] if draw.random() < 0.5 else item[draw.randint(0, 8):]
            text = text + part + text[:3]
        docs.append(" ".join(text).title())
    return [" ".join(i) for i in items], docs


@pytest.mark.parametrize("block_bytes", [1 << 24, 40])
def test_pairs_and_coverage_equal_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    items, docs = case(1)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(docs)], DOCS)
    bench = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)], ITEMS)
    want = {}
    for d, text in enumerate(docs):
        for i, item in enumerate(items):
            least = min(5, len(tokens(item)))
            share = plain_tiles(tokens(item), tokens(text), least) / len(tokens(item))
            if share >= 0.5:
                want[d, i] = share
    got = {(r.doc_id, r.item_id): r.coverage for r in contaminated(df, bench).collect()}
    assert got == want and len(want) > 5
    kept = drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(docs))) - {d for d, _ in want}


def test_reordered_passage_and_punctuation(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    words = item.split()
    df = spark.createDataFrame(
        [(1, "start " + " ".join(words[6:]) + ", then -- " + " ".join(words[:6]).upper() + "!", "", 0), (2, " ".join(words[:5]), "", 0),
         (3, None, "", 0), (4, "", "", 0), (None, item, "", 0), (5, item + " " + item, "", 0), (5, item + " " + item, "", 0),
         (6, "pad " * 30_000 + item, "", 0)], DOCS)
    bench = spark.createDataFrame([(9, item, 1), (None, None, 1), (8, "", 1), (7, "one two", 1)], ITEMS)
    got = contaminated(df, bench).collect()
    assert sorted((str(r.doc_id), r.item_id, r.coverage) for r in got) == [
        ("1", 9, 1.0), ("5", 9, 1.0), ("5", 9, 1.0), ("6", 9, 1.0), ("None", 9, 1.0)]
    assert contaminated(df, bench.limit(0)).collect() == [] and contaminated(df.limit(0), bench).collect() == []
    assert drop_contaminated(df, bench).count() == 3


def test_tiles_never_overlap():
    draw = np.random.default_rng(0)
    for _ in range(50):
        a, b = draw.integers(0, 2, 30), draw.integers(0, 2, 40)
        seeds = [(i, j) for i in range(26) for j in range(36) if (a[i : i + 5] == b[j : j + 5]).all()]
        if seeds:
            found = tiles(np.array([i for i, _ in seeds]), np.array([j for _, j in seeds]))
            for k in (0, 1):
                spots = [t[k] + n for t in found for n in range(t[2])]
                assert len(spots) == len(set(spots))
            assert sum(t[2] for t in found) == plain_tiles(list(a), list(b))


def test_short_items_are_found_whole_or_not_at_all(spark):
    texts = ["Well: the capital is \u201cParis\u201d, they say.", "the capital is the city of Paris", "capital is Paris the",
             "The CAPITAL is Paris. the capital is Paris", "is Paris"]
    df = spark.createDataFrame([(i, t, "", 0) for i, t in enumerate(texts)], DOCS)
    bench = spark.createDataFrame([(1, "the capital is Paris", 0), (2, "the capital is Paris", 0), (3, "is Paris", 0),
                                   (4, "city of Paris", 0)], ITEMS)
    got = sorted((r.doc_id, r.item_id, r.coverage, [tuple(t) for t in r.tiles]) for r in contaminated(df, bench).collect())
    assert got == [(0, 1, 1.0, [(0, 1, 4)]), (0, 2, 1.0, [(0, 1, 4)]), (1, 4, 1.0, [(0, 4, 3)]),
                   (3, 1, 1.0, [(0, 0, 4)]), (3, 2, 1.0, [(0, 0, 4)])]
    assert sorted(r.doc_id for r in drop_contaminated(df, bench).collect()) == [2, 4]


def test_case_forms_and_punctuation_of_any_script(spark):
    items = ["\u00e9t\u00e9 \u00e0 la mer avec toi", "\u041c\u043e\u0441\u043a\u0432\u0430 \u0433\u043e\u0440\u043e\u0434 \u043d\u0430 \u0440\u0435\u043a\u0435 \u0438 \u0445\u043e\u043b\u043c\u0430\u0445", "one two three four five six seven"]
    texts = [items[0].upper(), unicodedata.normalize("NFD", items[0]), items[1].upper(), "\u201c" + items[2] + "\u201d\u2014and",
             items[0].replace(" ", "\u2014"), "\uff4f\uff4e\uff45 two three four five six seven", "\u00e9t\u00e9 \u00e0 la plage"]
    df = spark.createDataFrame([(i, t, "", 0) for i, t in enumerate(texts)], DOCS)
    bench = spark.createDataFrame([(i, t, 0) for i, t in enumerate(items)], ITEMS)
    got = sorted((r.doc_id, r.item_id, r.coverage) for r in contaminated(df, bench).collect())
    assert got == [(0, 0, 1.0), (1, 0, 1.0), (2, 1, 1.0), (3, 2, 1.0), (4, 0, 1.0), (5, 2, 1.0)]


def test_ascii_texts_have_the_same_tokens_either_way():
    texts = ["A b_C d-9 \x00 e\tF", "", None, "x" * 50 + " Y?z"]
    short, long = decontaminate.tokens(pa.array(texts)), decontaminate.tokens(pa.array([*texts, "\u00e9"]))
    assert (short.hashes == long.hashes[: len(short.hashes)]).all() and list(short.counts) == list(long.counts[:4])
