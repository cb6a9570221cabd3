"""Near duplicates against brute force."""

import random
from itertools import combinations

import pytest

from tierflow.llm import near_dups
from tierflow.llm.components import components
from tierflow.llm.near_dups import depths, drop_near_duplicates, near_duplicates
from tierflow.llm.words import words_of

import pyarrow as pa

SCHEMA = "doc_id bigint, text string, key string, node bigint"


def shingled(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows, threshold=0.8):
    """doc_id -> (class, links) by comparing every pair."""
    sets = {i: shingled(t) for i, t in rows}
    texts = dict(rows)
    links = {i: 0 for i in sets}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        union = len(sets[a] | sets[b])
        if (texts[a] or "") == (texts[b] or "") or union and len(sets[a] & sets[b]) >= threshold * union:
            links[a] += 1
            links[b] += 1
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (find(i), links[i]) for i in sets}


def corpus(seed=1, families=25, members=6):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(families):
        base = [draw.choice(vocabulary) for _ in range(draw.choice([6, 40, 120, 300]))]
        for _ in range(draw.randint(1, members)):
            text = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, 8])):
                text[draw.randrange(len(text))] = draw.choice(vocabulary)
            rows.append((len(rows), " ".join(text)))
    rows += [(len(rows) + i, t) for i, t in enumerate([None, "", " ", "one", "one", "one two three", "ab"])]
    return rows


def result(df):
    return {r.doc_id: (r.class_id, r.links) for r in df.collect()}


def test_classes_and_links_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], SCHEMA)
    got, want = result(near_duplicates(df)), brute(rows)
    lost = sum(want[i][1] for i in want) - sum(got[i][1] for i in got)
    assert got.keys() == want.keys()
    assert lost <= 0.1 * sum(n for _, n in want.values())  # recall of links
    assert all(got[i][1] <= want[i][1] for i in want)  # verified: no false link
    assert sum(got[i] == want[i] for i in want) >= 0.95 * len(want)


def test_blocks_give_the_same_result_as_one_group(spark, monkeypatch):
    rows = [(i, " ".join([*(f"w{j}" for j in range(100)), f"x{i}"])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").cache()
    want = {i: (0, 39) for i in range(40)}
    assert result(near_duplicates(df)) == want
    monkeypatch.setattr(near_dups, "BLOCK_ROWS", 7)
    assert result(near_duplicates(df)) == want


def test_one_row_of_each_class_stays(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(3, long), (1, long + " end"), (1, long + " end"), (None, long), (None, None), (None, None), (7, "other text"),
            (8, "other text")]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], SCHEMA)
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(
        map(repr, [(1, long + " end"), (None, None), (7, "other text")])
    )


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_prefixes_shorten_until_the_target_recall():
    lengths = depths(0.8, 0.97)
    assert lengths[0] == near_dups.DEPTH and lengths == sorted(lengths, reverse=True)
    assert 1 - (1 - 0.8 ** lengths[-1]) ** near_dups.TREES >= 0.97
    assert depths(0.8, 0.5)[-1] > lengths[-1]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 50)] + [(5, 5)]
    got = {r.member: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(31)} | {100 + i: 100 for i in range(50)}


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_words_are_runs_between_ascii_blanks(kind):
    texts = ["a b c", None, "", " \t\n", "x", "yy\x0bzz\x1c", "éé  a"]
    words = words_of(pa.array(["skip", *texts], kind).slice(1))
    found = [[words.text(k).decode() for k in range(words.first[i], words.first[i + 1])] for i in range(len(texts))]
    assert found == [["a", "b c"], [], [], [], ["x"], ["yy", "zz\x1c"], ["éé", "a"]]
    assert words.hashes[0] == words.hashes[-1] and len(set(words.hashes.tolist())) == 6


def test_pairs_just_above_the_threshold_are_linked(spark):
    pairs = 400
    rows = []
    for i in range(pairs):
        base = [f"p{i}w{j}" for j in range(104)]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(base[:93] + [f"q{i}w{j}" for j in range(11)]))]
    assert len(shingled(rows[0][1]) & shingled(rows[1][1])) / len(shingled(rows[0][1]) | shingled(rows[1][1])) < 0.803
    got = result(near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert got == {i: (i // 2 * 2, 1) for i in range(2 * pairs)}


def test_no_link_between_different_texts_is_lost(spark):
    rows = corpus(seed=5)
    got = result(near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert got == brute(rows)
