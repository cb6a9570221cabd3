"""Dimensions of type 1 and 2 against brute force, under any split, order and repetition of batches."""

import random

import pytest
from pyspark.sql import functions as F

from tierflow.operators import scd
from tierflow.operators.skew import hot_keys, next_sequence

LOG = "k string, seq bigint, a string, b bigint"


def random_log(seed, n=300, keys=12, span=40):
    """Repeats, ties and one key that holds a third of all rows."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(keys)}"
        rows.append((key, rng.randrange(span), rng.choice("xyz"), rng.randrange(3)))
    return rows + rng.sample(rows, n // 5)


def brute_scd2(rows):
    best = {}
    for k, seq, a, b in rows:
        if k is not None and seq is not None:
            best[k, seq] = max(best.get((k, seq), ("", -1)), (a, b))
    out = set()
    for (k, seq), (a, b) in best.items():
        later = [s for (kk, s) in best if kk == k and s > seq]
        out.add((k, a, b, seq, min(later, default=None), not later))
    return out


def table(df):
    return {(r.k, r.a, r.b, r.start_date, r.end_date, r.is_active) for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("hot_rows", [10**9, 30, 1])
def test_scd2_build_is_brute_force(spark, seed, hot_rows):
    rows = random_log(seed) + [(None, 1, "x", 1), ("k1", None, "x", 1)]
    df = scd.scd2_build(spark.createDataFrame(rows, LOG), ["k"], "seq", hot_rows=hot_rows)
    assert df.count() == len(brute_scd2(rows))
    assert table(df) == brute_scd2(rows)


@pytest.mark.parametrize(("seed", "hot_rows"), [(0, 10**9), (1, 10**9), (2, 5)])
def test_scd2_apply_of_any_order_is_one_build(spark, seed, hot_rows, area):
    rows = random_log(seed, n=120)
    rng = random.Random(seed)
    shuffled = rng.sample(rows, len(rows))
    target = scd.scd2_build(spark.createDataFrame(shuffled[:50], LOG), ["k"], "seq")
    for number, part in enumerate((shuffled[40:90], shuffled[90:], [], shuffled[30:60])):
        stored = f"{area}/v{number}"
        target.write.parquet(stored)
        batch = spark.createDataFrame(part, LOG)
        target = scd.scd2_apply(spark.read.parquet(stored), batch, ["k"], "seq", hot_rows=hot_rows)
    assert target.count() == len(brute_scd2(rows))
    assert table(target) == brute_scd2(rows)


def test_scd2_open_end_and_flag(spark):
    log = spark.createDataFrame([("a", 1, "x", 1), ("a", 5, "y", 1)], LOG)
    rows = scd.flag_text(scd.scd2_build(log, ["k"], "seq", open_end=F.lit(99).cast("bigint")))
    assert {(r.start_date, r.end_date, r.is_active) for r in rows.collect()} == {(1, 5, "N"), (5, 99, "Y")}


def test_scd2_apply_with_open_end_keeps_it(spark):
    end = F.lit(99).cast("bigint")
    first = scd.scd2_build(spark.createDataFrame([("a", 1, "x", 1), ("b", 2, "x", 1)], LOG), ["k"], "seq", end)
    after = scd.scd2_apply(first, spark.createDataFrame([("a", 4, "y", 1)], LOG), ["k"], "seq", end)
    assert table(after) == {
        ("a", "x", 1, 1, 4, False), ("a", "y", 1, 4, 99, True), ("b", "x", 1, 2, 99, True),
    }


def test_two_changes_of_a_key_and_a_new_key_in_one_batch(spark):
    first = scd.scd2_build(spark.createDataFrame([("B01", 10, "old", 49), ("B02", 10, "old", 30)], LOG), ["k"], "seq")
    batch = [("B01", 20, "old", 59), ("B01", 30, "old", 69), ("B42", 40, "new", 11)]
    after = scd.scd2_apply(first, spark.createDataFrame(batch, LOG), ["k"], "seq")
    assert {(r.k, r.b) for r in scd.current_rows(after).collect()} == {("B01", 69), ("B02", 30), ("B42", 11)}
    assert {(r.k, r.b) for r in scd.as_of(after, F.lit(20)).collect()} == {("B01", 59), ("B02", 30)}


def test_intervals_are_contiguous_with_one_open_version(spark):
    rows = random_log(7)
    built = scd.scd2_build(spark.createDataFrame(rows, LOG), ["k"], "seq").collect()
    by_key = {}
    for r in built:
        by_key.setdefault(r.k, []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r.start_date)
        assert [r.is_active for r in versions] == [False] * (len(versions) - 1) + [True]
        assert all(x.end_date == y.start_date for x, y in zip(versions, versions[1:]))


def test_scd1_latest_row_with_status_filter_and_ties(spark):
    rows = [("a", 1, "insert", 1), ("a", 3, "delete", 9), ("a", 2, "update", 5), ("a", 2, "update", 7),
            ("b", 1, "delete", 1), (None, 5, "insert", 1), ("c", None, "insert", 1)]
    log = spark.createDataFrame(rows, LOG)
    latest = scd.scd1_build(log, ["k"], "seq", ("insert", "update"), "a")
    assert [tuple(r) for r in latest.collect()] == [("a", 2, "update", 7)]
    assert {r.k for r in scd.scd1_build(log, ["k"], "seq").collect()} == {"a", "b"}
    assert scd.unsequenced(log, ["k"], "seq").count() == 2


def test_scd1_apply_replaces_only_by_a_greater_sequence(spark):
    target = spark.createDataFrame([("a", 2, "x", 1), ("b", 2, "x", 1), ("c", 2, "x", 1)], LOG)
    batch = spark.createDataFrame([("a", 1, "y", 2), ("b", 2, "y", 2), ("c", 3, "y", 2), ("d", 1, "y", 2)], LOG)
    rows = {tuple(r) for r in scd.scd1_apply(target, batch, ["k"], "seq").collect()}
    assert rows == {("a", 2, "x", 1), ("b", 2, "x", 1), ("c", 3, "y", 2), ("d", 1, "y", 2)}


def test_hot_keys_are_those_above_the_limit_null_among_them(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 20).alias("k"), F.col("id").alias("seq"))
    assert {(r._key.k0, r._rows) for r in hot_keys(rows, ["k"], hot_rows=999).collect()} == {(None, 1000)}
    assert hot_keys(rows, ["k"], hot_rows=1000).isEmpty()


def plain_lead(rows):
    """(row, next sequence) of each row, NULLs first, then by all columns."""
    order = lambda v: (v is not None, v) if v is not None else (False,)
    by_key = {}
    for row in rows:
        by_key.setdefault(row[0], []).append(row)
    out = []
    for own in by_key.values():
        own.sort(key=lambda r: [order(v) for v in r[1:]])
        out += [(*a, b[1]) for a, b in zip(own, [*own[1:], (None, None)])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("hot_rows", [1, 60, 10**9])
def test_lead_keeps_every_row_whatever_the_size_of_a_key(spark, kind, hot_rows):
    """Ties, copies, NULL sequences and NULL keys give the same rows in one window or in ranges."""
    rng = random.Random(3)
    rows = []
    for _ in range(500):
        key = rng.choice(["hot", "hot", None, *(f"k{i}" for i in range(8))])
        seq = rng.choice([None, *range(30)])
        rows.append((key, seq if kind == "bigint" or seq is None else f"s{seq:02d}", rng.choice("xyz")))
    rows += [("hot", rows[0][1], "x")] * 150
    got = next_sequence(spark.createDataFrame(rows, f"k string, seq {kind}, a string"), ["k"], "seq", "nxt", hot_rows)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_lead(rows)


def test_a_hot_key_and_a_pile_of_copies_are_cut_into_ranges(spark):
    from tierflow.operators import skew

    rows = spark.range(30_000).select(F.lit(-1).alias("k"), F.least("id", F.lit(9_000)).alias("seq"))
    keyed = rows.withColumn("_key", skew.key_struct(["k"])).join(hot_keys(rows, ["k"], 1000), "_key")
    got = skew._lead_in_ranges(keyed, ["k"], "seq", "nxt", 1000)
    assert got.count() == 30_000 and got.where("nxt IS NULL").count() == 1
    assert got.where("seq < 9000 AND nxt <> seq + 1").isEmpty() and got.where("nxt = 9000").count() == 21_000
