"""What is kept beside the data: statistics by deltas, snapshots by digests, sketches and audits of loads."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from test_streams import rows_of, spoil
from tierflow.operators.changes import change_feed, differing_buckets
from tierflow.operators.reduce import key_sketches, keys_of_sketches
from tierflow.sources.tables import read_batches
from tierflow.streaming.key_filter import KeyFilter, new_rows, slots_for
from tierflow.streaming.rollups import DeltaStats, JoinedStats, own_copy
from tierflow.streaming.sinks import KeyedLog, touched_buckets, write_audited
from tierflow.streaming.snapshots import Snapshots

FACT, DIM = "id bigint, book string, at string, n double", "book string, author string"


def kept_in(area):
    return JoinedStats(
        DeltaStats(f"{area}/stats", StructType.fromDDL("at string, author string")),
        own_copy(f"{area}/facts", StructType.fromDDL(FACT), ("id", "book"), "book"),
        own_copy(f"{area}/books", StructType.fromDDL(DIM), ("book",), "book"), "book", "n",
    )


def recomputed(facts, books):
    groups = {}
    for _, book, at, n in facts.values():
        if book in books:
            groups.setdefault((at, books[book]), []).append(n)
    mean = lambda v: sum(v) / len(v) if v else None
    return sorted(((*g, len(v), mean([n for n in v if n is not None])) for g, v in groups.items()), key=repr)


def test_deltas_equal_recomputation(spark, area):
    rng, kept = random.Random(2), kept_in(area)
    facts, books = {}, {}

    def state(rows, schema):
        return spark.createDataFrame(rows, schema)

    for number in range(4):
        old_facts, old_books = dict(facts), dict(books)
        for i in rng.sample(range(40), 25):
            facts[i] = (i, f"b{rng.randrange(6)}", f"t{rng.randrange(3)}", rng.choice([0.1, 0.2, 2.5, -1.0, None]))
        for i in rng.sample(range(40), 8):
            facts.pop(i, None)
        for b in rng.sample(range(6), 3):
            books[f"b{b}"] = f"a{rng.randrange(3)}"
        if number % 2:
            books.pop(f"b{rng.randrange(6)}", None)
        change = change_feed(state(list(old_facts.values()), FACT), state(list(facts.values()), FACT), ["id"], number)
        kept.fact_changes(change, number)
        news = change_feed(state(list(old_books.items()), DIM), state(list(books.items()), DIM), ["book"], number)
        for _ in range(1 + number % 2):  # a batch that is done again
            kept.dimension_changes(news, number)
        if number == 2:
            kept.stats.fold(spark)
        got = kept.stats.read(spark).select("at", "author", "n_rows", "avg_value").collect()
        want = recomputed(facts, books)
        assert [(r[0], r[1], r[2]) for r in sorted(map(tuple, got), key=repr)] == [w[:3] for w in want]
        assert [r[3] for r in sorted(map(tuple, got), key=repr)] == pytest.approx([w[3] for w in want])


def test_a_delta_batch_costs_its_groups_and_cancels_exactly(spark, area):
    stats = DeltaStats(f"{area}/stats", StructType.fromDDL("g string"))
    rows = lambda sign, n: spark.range(n).select(F.lit("x").alias("g"), F.lit(0.1).alias("v"), F.lit(sign).cast("bigint").alias("_sign"))
    assert stats.read(spark).isEmpty()
    stats.add(rows(1, 30_000), "v", 0, "facts")
    assert spark.read.parquet(f"{area}/stats/facts").count() == 1
    stats.add(rows(-1, 29_999), "v", 1, "facts")
    assert rows_of(stats.read(spark).select("g", "n_rows", "n_values", F.col("sum_value").cast("string"), "avg_value")) == [
        ("x", 1, 1, "0.100000", 0.1)]
    stats.add(rows(-1, 1), "v", 0, "dimension")
    assert stats.read(spark).isEmpty()


def test_both_sides_are_placed_by_the_join_column():
    facts = KeyedLog("f", StructType.fromDDL(FACT), ("id", "book"))
    books = KeyedLog("b", StructType.fromDDL(DIM), ("book",))
    with pytest.raises(ValueError):
        JoinedStats(DeltaStats("s", StructType()), facts, books, "book", "n")
    with pytest.raises(ValueError):
        KeyedLog("f", StructType.fromDDL(FACT), ("id",), bucket_by=("book",))


def test_snapshots_are_read_only_where_their_digests_differ(spark, area):
    fields = "k bigint, t string, v double"
    rows = [(i, None if i % 7 == 0 else f"t{i}", None if i % 5 == 0 else float(i)) for i in range(300)]
    changed = [(k, t, -1.0 if k == 10 else v) for k, t, v in rows if k != 11] + [(1000, "new", 1.0)]
    before, after = (spark.createDataFrame(r, fields) for r in (rows, changed))
    table = Snapshots(area, before.schema, ["k"], buckets=16)
    table.store(before, 0)
    table.store(after.orderBy(F.rand(1)), 1)
    table.store(before.orderBy(F.rand(2)), 2)
    of = differing_buckets(table.digests(spark, 0), table.digests(spark, 1))
    assert of == touched_buckets(spark.createDataFrame([(10,), (11,), (1000,)], "k bigint"), ["k"], 16)
    assert differing_buckets(table.digests(spark, 0), table.digests(spark, 2)) == []
    want = change_feed(before, after, ["k"], 5).select("k", "t", "v", "_change_type").collect()
    spoil([f"{d}/{f}" for d, _, names in os.walk(f"{area}/rows") for f in names
           if f.endswith(".parquet") and int(d.rpartition("=")[2]) not in of])
    table = Snapshots(area, before.schema, ["k"], buckets=16)
    got = table.changes(spark, 0, 1, 5).drop("_commit_timestamp")
    assert sorted(map(repr, got.select("k", "t", "v", "_change_type").collect())) == sorted(map(repr, want)) and len(want) == 4


def test_sketches_of_loads_add_up(spark):
    rows = spark.range(60_000).select((F.col("id") % 5).alias("load"), (F.col("id") % 17_000).alias("k"), F.lit("x").alias("g"))
    rows = rows.unionByName(spark.createDataFrame([(0, None, "x"), (1, None, "none")], "load bigint, k bigint, g string"))
    sketches = key_sketches(rows, ["k"], "load", "g")
    assert sketches.agg(F.max(F.length("keys_sketch"))).first()[0] < 20_000
    got = {r.g: r.n_keys for r in keys_of_sketches(sketches, "g").collect()}
    assert abs(got["x"] - 17_000) < 17_000 * 0.04 and got["none"] == 0


def test_an_audit_row_is_taken_while_the_batch_is_written(spark, area):
    rows = spark.createDataFrame([(1, 5), (2, 9)], "id bigint, ts bigint")
    for number, part in ((0, rows), (1, rows.where("id > 1")), (0, rows), (2, rows.limit(0))):
        write_audited(part, f"{area}/log", number, "ts", f"{area}/audit")
    assert rows_of(read_batches(spark, f"{area}/audit").where("n_rows > 0").select("batch_id", "n_rows", "first_ts", "last_ts")) == [
        (0, 2, 5, 9), (1, 1, 9, 9)]
    assert read_batches(spark, f"{area}/audit").where("batch_id = 2 AND n_rows = 0 AND first_ts IS NULL").count() == 1


@pytest.mark.parametrize("slots", [1, 8])
def test_a_filtered_merge_is_exact_however_many_false_positives(spark, area, slots):
    """With one slot for 20,000 keys most bits are set and most new keys look possible; the rows are the same."""
    target = spark.range(20_000).select((F.col("id") * 3).alias("k"), F.lit("old").alias("v"))
    known = KeyFilter(area, ["k"], slots)
    known.add(target.where("k < 30000"), 0)
    known.add(target.where("k >= 30000"), 1)
    fields = "k bigint, v string"
    source = spark.range(0, 70_000, 7).select(F.col("id").alias("k"), F.lit("new").alias("v")).unionByName(
        spark.createDataFrame([(7, "zzz"), (None, "x"), (None, "y"), (-1, "new")], fields))
    got = new_rows(target, source, ["k"], known)
    want = [(k, "zzz" if k == 7 else "new") for k in range(0, 70_000, 7) if k % 3 or k >= 60_000]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, [*want, (None, "y"), (-1, "new")]))
    tested = known.tested(source.where("k IS NOT NULL"), "hit")
    assert tested.where("NOT hit AND k % 3 = 0 AND k BETWEEN 0 AND 59999").isEmpty()
    false = tested.where("hit AND (k % 3 <> 0 OR k >= 60000)").count() / len(want)
    assert (0.6 < false < 0.8) if slots == 1 else false < 0.05
    assert KeyFilter(f"{area}/none", ["k"], 8).tested(source, "hit").where("hit").isEmpty()
    assert slots_for(0) == 1 and slots_for(1_000_000) == 367
