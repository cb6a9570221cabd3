import random

import pytest
from pyspark.sql import functions as F

from tierflow.operators import changes as cdc
from tierflow.operators import merge
from tierflow.operators.reduce import count_keys, in_given_order, latest_per_key, string_agg
from tierflow.operators.shape import conform, nest_lines, order_lines, union_widened

ROW = "k string, v bigint, seen bigint"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_replaying_a_change_feed_gives_the_later_snapshot(spark, seed):
    rng = random.Random(seed)
    snapshots = [
        spark.createDataFrame([(f"k{i}", rng.randrange(3), 0) for i in range(60) if rng.random() < 0.7], ROW)
        for _ in range(2)
    ]
    feed = cdc.change_feed(*snapshots, ["k"], 4)
    assert rows_of(cdc.replay(snapshots[0], feed, ["k"])) == rows_of(snapshots[1])
    assert {r._change_type for r in feed.collect()} == {"insert", "delete", "update_preimage", "update_postimage"}
    assert cdc.change_feed(snapshots[0], snapshots[0], ["k"], 5).isEmpty()


def test_change_feed_sees_a_value_turn_null(spark):
    before, after = (spark.createDataFrame([("a", v, 0)], ROW) for v in (1, None))
    assert [(r._change_type, r.v) for r in cdc.change_feed(before, after, ["k"], 1).collect()] == [
        ("update_preimage", 1), ("update_postimage", None),
    ]


CHANGES = "k string, v bigint, _change_type string, _commit_version bigint, _commit_timestamp bigint"


def test_cdf_upsert_takes_the_latest_new_image(spark):
    target = spark.createDataFrame(
        [("a", 1, 1, 10), ("b", 1, 3, 30)], "k string, v bigint, processed_version bigint, processed_timestamp bigint")
    feed = spark.createDataFrame(
        [("a", 2, "update_postimage", 2, 20), ("a", 0, "update_preimage", 2, 25), ("a", 3, "insert", 1, 15),
         ("b", 2, "update_postimage", 2, 20), ("c", 5, "insert", 1, 1), ("d", 5, "delete", 1, 99)], CHANGES)
    assert rows_of(cdc.cdf_upsert(target, feed, ["k"])) == [("a", 2, 2, 20), ("b", 1, 3, 30), ("c", 5, 1, 1)]


def test_images_go_by_version_not_by_the_clock(spark):
    feed = spark.createDataFrame([("a", 9, "insert", 1, 50), ("a", 1, "update_postimage", 2, 50),
                                  ("b", 9, "insert", 1, 50), ("b", 1, "update_postimage", 2, 40)], CHANGES)
    assert [r.v for r in cdc.newest_images(feed, ["k"]).collect()] == [1, 1]
    target = cdc.newest_images(feed.where("_commit_version = 1"), ["k"])
    assert [r.v for r in cdc.cdf_upsert(target, feed, ["k"]).collect()] == [1, 1]


def test_changes_of_a_range_of_versions(spark):
    feed = spark.createDataFrame([("a", v, "insert", v, 0) for v in range(5)], CHANGES)
    assert [r.v for r in cdc.between_versions(feed, 1, 3).orderBy("v").collect()] == [1, 2, 3]
    assert cdc.between_versions(feed, 3).count() == 2


def test_merge_upsert_without_order_replaces_every_match(spark):
    target = spark.createDataFrame([("a", 1, 5), ("b", 1, 5), (None, 1, 5)], ROW)
    source = spark.createDataFrame([("a", 2, 1), ("c", 2, 1), (None, 2, 1)], ROW)
    assert rows_of(merge.merge_upsert(target, source, ["k"])) == sorted(
        [("a", 2, 1), ("b", 1, 5), ("c", 2, 1), (None, 1, 5), (None, 2, 1)], key=repr)


def test_insert_only_merge_takes_one_of_several_copies(spark):
    target = spark.createDataFrame([("a", 1, 5)], ROW)
    source = spark.createDataFrame([("a", 2, 1), ("c", 2, 1), ("c", 3, 1)], ROW)
    once = merge.merge_insert_only(target, source, ["k"])
    assert rows_of(once) == [("a", 1, 5), ("c", 3, 1)]
    assert rows_of(merge.merge_insert_only(once, source, ["k"])) == rows_of(once)


def test_marks_start_empty_and_never_move_back(spark):
    marks = merge.start_marks(spark, ["x", "y"], "bigint")
    seen = spark.createDataFrame([("x", 5), ("x", 3), ("z", 1)], "t string, at bigint")
    marks = merge.advance_marks(marks, seen, "t", "at")
    marks = merge.advance_marks(marks, spark.createDataFrame([("x", 4)], "t string, at bigint"), "t", "at")
    assert rows_of(marks) == [("x", 5), ("y", None), ("z", 1)]


def test_incremental_slice_on_a_filled_and_an_empty_target(spark):
    source = spark.sql("SELECT timestamp'2024-01-01' + make_interval(0,0,0,id) AS at FROM range(5)")
    done = source.where("at < timestamp'2024-01-03'")
    assert merge.incremental_slice(source, done, "at").count() == 3
    assert merge.incremental_slice(source, done.limit(0), "at").count() == 5
    assert merge.incremental_slice(source, done.limit(0), "at", "2024-01-04").count() == 1


def test_load_history_and_latest_load(spark):
    log = spark.createDataFrame([(0, 5), (0, 7), (2, 1)], "n int, at int")
    assert rows_of(cdc.load_history(log, "n", "at")) == [(0, 2, 5, 7), (2, 1, 1, 1)]
    assert rows_of(cdc.latest_load(log, "n")) == [(2, 1)]


def test_latest_per_key_ties_and_null_keys(spark):
    rows = [("a", 1, 5), ("a", 2, 5), ("a", 9, 4), (None, 1, 1), (None, 2, 1), ("n", 1, None)]
    df = spark.createDataFrame(rows, ROW)
    assert rows_of(latest_per_key(df, ["k"], "seen")) == sorted([r for r in rows if r != ("a", 9, 4)], key=repr)
    assert rows_of(latest_per_key(df, ["k"], "seen", ties="one")) == sorted(
        [("a", 2, 5), (None, 2, 1), ("n", 1, None)], key=repr)


def test_two_overlapping_customer_feeds(spark):
    """300 rows each over 207 and 205 customers, 16 of them shared: 396 latest rows, 191 and 205 by feed."""
    def feed(first, customers, start):
        return [(f"C{first + i % customers:05d}", start + i) for i in range(300)]

    one = spark.createDataFrame(feed(0, 207, 0), "customer_id string, row_time int").withColumn("f", F.lit(1))
    two = spark.createDataFrame(feed(191, 205, 1000), "customer_id string, row_time int").withColumn("f", F.lit(2))
    both = one.union(two)
    assert rows_of(count_keys(both, ["customer_id"], "f")) == [(1, 207), (2, 205)]
    latest = latest_per_key(both, ["customer_id"], "row_time")
    assert latest.count() == 396
    assert rows_of(latest.groupBy("f").count()) == [(1, 191), (2, 205)]


def test_string_agg_is_sorted_and_distinct(spark):
    df = spark.createDataFrame([("t", "b"), ("t", "a"), ("t", "b"), ("u", "c")], "t string, c string")
    assert rows_of(string_agg(df, ["t"], F.col("c"), "cs")) == [("t", "a,b"), ("u", "c")]


def test_given_order_puts_unknown_values_last(spark):
    df = spark.createDataFrame([("z",), ("b",), ("a",), (None,)], "c string")
    assert [r.c for r in df.orderBy(in_given_order("c", ["b", "a"]), "c").collect()] == ["b", "a", None, "z"]


def test_conform_splits_rows_that_break_not_null_and_keeps_their_values(spark):
    df = spark.createDataFrame([("1", "2.5"), ("x", "1"), ("2", None)], "id string, v string")
    good, bad = conform(df, "id BIGINT NOT NULL, v DOUBLE", required=["v"])
    assert rows_of(good) == [(1, 2.5)]
    assert rows_of(bad) == sorted([("x", "1", "id"), ("2", None, "v")], key=repr)


def test_an_order_of_any_length_is_one_row(spark):
    lines = spark.range(1, 10_002).select(F.lit("o").alias("o"), F.col("id").alias("n"), (F.col("id") * 2).alias("q"))
    nested = nest_lines(lines, ["o"], ["q"], "n", "items")
    assert [len(r["items"]) for r in nested.collect()] == [10_001]
    assert rows_of(nested.select("o", F.inline("items"))) == rows_of(lines)


def test_order_lines_keep_line_values_and_drop_empty_orders(spark):
    orders = spark.createDataFrame(
        [("o1", 2, [("B09", 1, 24), ("B01", 1, 49)]), ("o2", 0, []), ("o3", 0, None), ("o4", 1, [("zz", 1, 1)])],
        "order_id string, quantity bigint, books array<struct<book_id: string, quantity: bigint, subtotal: bigint>>")
    books = spark.createDataFrame([("B09", "x"), ("B01", "y")], "book_id string, author string")
    got = order_lines(orders, books, "books", "book_id", "book_id")
    assert rows_of(got.select("order_id", "quantity", "line_book_id", "line_subtotal", "author")) == [
        ("o1", 2, "B01", 49, "y"), ("o1", 2, "B09", 24, "x")]


def test_union_widened_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("n", 2)], "y string, x int")
    assert rows_of(union_widened(a, b)) == [(1, None), (2, "n")]
