"""Curriculum mixing against a plain restatement."""

from pyspark.sql import functions as F

from tierflow.llm import mixing
from tierflow.llm.mixing import curriculum, training_order
from tierflow.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, source string, size string, block int"


def filled(sizes):
    """Targets by resharing the excess until none is above three times its size."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, target = sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        for s in full:
            target[s] = 3.0 * sizes[s]
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def rows():
    out = [(i, "w " * (i % 17), s, "x", 3) for i in range(400) for s in [("a", "b", "b", "b", "é", None, "Z")[i % 7]]]
    return out + [(500, None, "none", "x", 3), (501, "", "none", "x", 3), (None, "a b", "a", "x", 3), (None, "a b", "a", "x", 3),
                  (502, "many " * 30_000, "b", "x", 3)]


def test_targets_taken_words_and_order(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    got = curriculum(df).collect()
    sizes = {}
    for _, t, s, *_ in rows():
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = filled(sizes)
    assert len(got) == len(rows())
    for s in sizes:
        own = [r for r in got if r.source == s]
        assert all(r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 for r in own)
        assert abs(sum(r.taken for r in own) - want[s]) <= 1
        assert all(0 <= r.taken <= 3 * r.size for r in own)
        assert all((r.position is None) == (r.taken == 0) for r in own)
    assert sorted(map(repr, got)) == sorted(map(repr, curriculum(df.repartition(5)).collect()))


def test_training_order_reads_every_taken_word_in_time(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    readings = training_order(df).collect()
    assert [r.position for r in readings] == sorted(r.position for r in readings)
    assert all(0 <= r.position <= 1 and 0 < r.words <= r.size for r in readings)
    assert sum(r.words for r in readings) == sum(r.taken for r in curriculum(df).collect())
    # The lightest sources come late: fewer of their words are read in the first half.
    late = [r for r in readings if r.source == "b"]
    assert sum(r.words for r in late if r.position < 0.5) > 0


def test_readings_carry_their_own_text_where_ids_repeat(spark):
    pairs = [(None, "a b c", "s"), (None, "d e f", "s"), (1, "g h", "s"), (1, "g h", "s"), (1, "i j", None), (1, None, "s")]
    readings = training_order(spark.createDataFrame(pairs, "doc_id bigint, text string, source string")).collect()
    assert all(r.size == len(r.text.split()) for r in readings)
    first = sorted((str(r.doc_id), r.text, str(r.source)) for r in readings if r.repeat == 0)
    assert first == sorted((str(d), t, str(s)) for d, t, s in pairs if t)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert curriculum(df).collect() == [] and training_order(df).collect() == []


def test_taken_words_are_those_of_the_readings(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    got, want = mixing.taken_in_order(df), curriculum(df)
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))
    assert mixing.taken_in_order(df.limit(0)).collect() == []


def test_query_counts_what_the_training_order_reads(spark, monkeypatch):
    seen = []

    def first_readings(mix, whole=mixing.readings):
        seen.append([r.position for r in whole(mix).collect()])
        return whole(mix).where("repeat = 0")

    monkeypatch.setattr(mixing, "readings", first_readings)
    got = QUERIES["op5_curriculum_mix"](spark, "/root/testdata/sf0.001")
    assert got.where("taken > size").count() == 0 and got.where("target > source_size AND taken = size").count() > 0
    assert seen == [sorted(seen[0])] and got.agg(F.count("position")).first()[0] <= len(seen[0])
