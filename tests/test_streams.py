"""Streams run to completion: restarts, repeats, late rows, empty batches, and the layers end to end."""

import json
import os
import random
import shutil
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F
from test_feed import line

from compare import differences
from tierflow.operators.scd import as_of, current_rows, scd2_build
from tierflow.plans import QUERIES, SQL, layers
from tierflow.sources.feed import raw_feed
from tierflow.sources.registry import RETAIL
from tierflow.sources.tables import read_batches
from tierflow.streaming.operators import TimeBound, dedup_stream, stream_join, tumbling_stats
from tierflow.streaming.intervals import IntervalTable
from tierflow.streaming.sinks import KeyedLog, append_batches, run_stream, touched_buckets, write_batch

TIMED = "id bigint, ts timestamp, v bigint"


def land(spark, path, rows, schema="id bigint, t string, v bigint"):
    df = spark.createDataFrame(rows, schema)
    if "t" in df.columns:
        df = df.select("id", F.col("t").cast("timestamp").alias("ts"), "v")
    df.coalesce(1).write.mode("append").parquet(path)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("salts", [1, 3])
def test_dedup_drops_copies_across_runs_and_rows_behind_the_watermark(spark, area, salts):
    def run():
        rows = spark.readStream.schema(TIMED).parquet(f"{area}/in")
        run_stream(dedup_stream(rows, ["id", "ts"], "ts", "30 seconds", salts), f"{area}/out", f"{area}/marks")

    land(spark, f"{area}/in", [(1, "2024-01-01 00:10:00", 1)] * 5 + [(2, "2024-01-01 00:09:00", 1)])
    run()
    land(spark, f"{area}/in", [(1, "2024-01-01 00:10:00", 1), (3, "2024-01-01 00:09:30", 1),
                               (4, "2024-01-01 00:09:31", 1), (5, "2024-01-01 00:20:00", 1)])
    run()
    run()
    assert [r[0] for r in rows_of(spark.read.parquet(f"{area}/out"))] == [1, 2, 4, 5]


def test_closed_windows_equal_the_batch_result(spark, area):
    rows = [(i, f"2024-01-01 00:{i % 60:02d}:00", i) for i in range(90)]
    land(spark, f"{area}/in", rows)
    shape = dict(ts="ts", width="5 minutes", keys=["g"], count_col="id", avg_col="v")
    grouped = lambda df: df.withColumn("g", F.col("id") % 2)
    stream = grouped(spark.readStream.schema(TIMED).parquet(f"{area}/in"))
    run_stream(tumbling_stats(stream, **shape, delay="10 minutes"), f"{area}/out", f"{area}/marks")
    batch = tumbling_stats(grouped(spark.read.parquet(f"{area}/in")), **shape)
    closed = batch.where("window_end <= timestamp'2024-01-01 00:49:00'")
    assert rows_of(spark.read.parquet(f"{area}/out")) == rows_of(closed)


@pytest.mark.parametrize("salts", [1, 3])
def test_bounded_stream_join_keeps_pairs_within_reach(spark, area, salts):
    land(spark, f"{area}/l", [(1, "2024-01-01 00:10:00", 1), (1, "2024-01-01 02:00:00", 2)])
    land(spark, f"{area}/r", [(1, "2024-01-01 00:15:00", 7), (1, "2024-01-01 01:00:00", 8), (2, "2024-01-01 00:10:00", 9)])
    left = spark.readStream.schema(TIMED).parquet(f"{area}/l").withColumnsRenamed({"ts": "l_ts", "v": "l_v"})
    right = spark.readStream.schema(TIMED).parquet(f"{area}/r").withColumnsRenamed({"ts": "r_ts", "v": "r_v"})
    bound = TimeBound("l_ts", "r_ts", delay="3 hours", within="10 minutes")
    run_stream(stream_join(left, right, ["id"], bound, salts), f"{area}/out", f"{area}/marks")
    assert rows_of(spark.read.parquet(f"{area}/out").select("id", "l_v", "r_v")) == [(1, 1, 7)]


PAIR = "k bigint, v bigint"


def size_of(folder):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


@pytest.mark.parametrize("track", [False, True])
def test_a_keyed_table_survives_new_checkpoints_other_streams_and_replays(spark, area, track):
    table = KeyedLog(f"{area}/table", spark.createDataFrame([], PAIR).schema, ("k",), ("v",))

    def run(name, mark):
        rows = spark.readStream.schema(PAIR).parquet(f"{area}/{name}")
        layers.scd1_stream_into(rows, table, f"{area}/marks-{mark}", track=track)

    assert table.read(spark).isEmpty()
    land(spark, f"{area}/a", [(1, 10), (2, 10)], PAIR)
    run("a", "a")
    land(spark, f"{area}/a", [(2, 30), (3, 30), (1, 5)], PAIR)
    run("a", "a")
    assert rows_of(table.read(spark)) == [(1, 10), (2, 30), (3, 30)]
    run("a", "a-again")  # the same stream from a new checkpoint
    land(spark, f"{area}/b", [(1, 40)], PAIR)
    run("b", "b")
    want = [(1, 40), (2, 30), (3, 30)]
    assert rows_of(table.read(spark)) == want
    table.compact(spark)
    assert rows_of(table.read(spark)) == want
    land(spark, f"{area}/b", [(4, 1)], PAIR)
    run("b", "b")
    assert rows_of(table.read(spark)) == [*want, (4, 1)]
    if track:
        changes = read_batches(spark, table.changes_path)
        assert rows_of(changes.select("_commit_version", "k", "v", "_change_type")) == [
            (0, 1, 10, "insert"), (0, 2, 10, "insert"), (1, 2, 10, "update_preimage"), (1, 2, 30, "update_postimage"),
            (1, 3, 30, "insert"), (2, 1, 10, "update_preimage"), (2, 1, 40, "update_postimage"), (3, 4, 1, "insert")]


def test_a_replayed_batch_replaces_itself_and_costs_its_own_rows(spark, area):
    table = KeyedLog(f"{area}/table", spark.createDataFrame([], PAIR).schema, ("k",), ("v",))
    table.append(spark.range(20_000).select(F.col("id").alias("k"), F.col("id").alias("v")), 0)
    whole = size_of(f"{area}/table")
    for _ in range(2):
        table.append(spark.createDataFrame([(3, 99_999)], PAIR), 1)
    assert size_of(f"{area}/table") - whole < whole / 20
    assert table.read(spark).count() == 20_000 and table.read(spark).where("v = 99999").count() == 1


def test_what_came_first_stays(spark, area):
    table = KeyedLog(f"{area}/table", spark.createDataFrame([], PAIR).schema, ("k",), first=True)
    for number, rows in enumerate([[(1, 5)], [(1, 9), (2, 9)], [(2, 1)]]):
        table.append(spark.createDataFrame(rows, PAIR), number)
        assert rows_of(table.read(spark)) == [(1, 5), (2, 9)][: number + 1]
    table.compact(spark)
    table.append(spark.createDataFrame([(1, 7), (3, 7)], PAIR), 3)
    assert rows_of(table.read(spark)) == [(1, 5), (2, 9), (3, 7)]


def test_appended_batches_survive_a_second_checkpoint(spark, area):
    for mark in "AB":
        land(spark, f"{area}/in-{mark}", [(1 if mark == "A" else 2, 0)], PAIR)
        append_batches(spark.readStream.schema(PAIR).parquet(f"{area}/in-{mark}"), f"{area}/out", f"{area}/marks-{mark}")
    assert rows_of(read_batches(spark, f"{area}/out").select("k")) == [(1,), (2,)]


@pytest.fixture
def shop(spark, area):
    """A landing folder, the streams from it and two deliveries."""
    def deliver(number, messages):
        os.makedirs(f"{area}/landing", exist_ok=True)
        with open(f"{area}/landing/feed_0{number}.json", "w") as f:
            f.write("\n".join(line(t, v, i) for i, (t, v) in enumerate(messages)))

    return deliver


def book(ident, price, at, author="A"):
    return "books", {"book_id": ident, "title": "t" + ident, "author": author, "price": price, "updated": at}


def customer(ident, city, at, status="insert", code="FR"):
    return "customers", {"customer_id": ident, "city": city, "row_status": status, "row_time": at, "country_code": code}


def order(ident, at, who, *lines):
    books = [{"book_id": b, "quantity": n, "subtotal": n * 10} for b, n in lines]
    return "orders", {"order_id": ident, "order_timestamp": at, "customer_id": who, "quantity": len(lines),
                      "total": 10, "books": books}


def test_layers_end_to_end(spark, area, shop):
    landing, out = f"{area}/landing", f"{area}/out"
    customers = KeyedLog(f"{out}/customers", spark.createDataFrame(
        [], "customer_id string, city string, country string, row_status string, row_time timestamp").schema,
        ("customer_id",), ("row_time",))
    orders = KeyedLog(f"{out}/orders", RETAIL["orders"].struct, RETAIL["orders"].keys, first=True)
    lookup = spark.createDataFrame([("FR", "France"), ("IN", "India")], "code string, country string")

    def stream(topic):
        return layers.bronze_topic(spark, f"{out}/bronze", RETAIL[topic], streaming=True)

    def run():
        feed = raw_feed(spark, landing, streaming=True, path_glob="feed_*.json")
        layers.bronze(feed, RETAIL, f"{out}/bronze", f"{out}/marks/bronze")
        layers.scd2_stream_into(stream("books").drop("source_file", "insert_ts", "key", "create_ts"), ["book_id"],
                                "updated", f"{out}/books", f"{out}/marks/books")
        layers.scd1_stream_into(layers.customers_with_country(stream("customers"), lookup).select(
            *customers.schema.names), customers, f"{out}/marks/customers", ("insert", "update"), "row_status")
        layers.orders_stream_into(stream("orders"), orders, "order_timestamp", f"{out}/marks/orders", salts=2)

    shop(1, [book("B1", 49.0, "2024-01-01T00:00:00Z"), book("B2", 10.0, "2024-01-01T00:00:00Z", "Z"),
             customer("C1", "Lyon", "2024-01-01T00:00:00Z"), customer("C2", "Pune", "2024-01-01T00:00:00Z", code="IN"),
             customer("C3", "Nowhere", "2024-01-01T00:00:00Z", code="XX"),
             order("O1", "2024-01-01T00:01:00Z", "C1", ("B1", 2), ("B2", 1)),
             order("O1", "2024-01-01T00:01:00Z", "C1", ("B1", 2), ("B2", 1)),
             ("films", {"id": 1}), ("books", "{broken")])
    run()
    shop(2, [book("B1", 69.0, "2024-01-03T00:00:00Z"), book("B1", 59.0, "2024-01-02T00:00:00Z"),
             customer("C1", "Paris", "2024-01-02T00:00:00Z", "update"), customer("C2", "old", "2023-01-01T00:00:00Z"),
             customer("C2", "gone", "2025-01-01T00:00:00Z", "delete", "IN"),
             order("O1", "2024-01-01T00:01:00Z", "C1", ("B1", 2)),
             order("O2", "2024-01-01T00:02:00Z", "C2", ("B1", 4)), order("O3", "2024-01-01T00:03:00Z", "C2")])
    run()
    run()

    books = layers.scd2_table(spark, f"{out}/books", ["book_id"], "updated")
    assert rows_of(books.where("book_id = 'B1'").select("price", "is_active")) == [
        (49.0, False), (59.0, False), (69.0, True)]
    assert rows_of(current_rows(books).select("book_id", "price")) == [("B1", 69.0), ("B2", 10.0)]
    people = customers.read(spark)
    assert rows_of(people.select("customer_id", "city", "country")) == [
        ("C1", "Paris", "France"), ("C2", "Pune", "India")]
    bought = orders.read(spark)
    assert rows_of(bought.select("order_id", F.size("books"))) == [("O1", 2), ("O2", 1), ("O3", 0)]
    assert sorted(r.reason for r in layers.bronze_quarantine(spark, f"{out}/bronze").collect()) == [
        "unknown topic", "unreadable value"]
    assert layers.bronze_feed(spark, f"{out}/bronze").count() == 17

    lines = layers.orders_books(bought, layers.keep_current(books, f"{out}/currentbooks"))
    assert rows_of(lines.select("order_id", "line_book_id", "line_quantity", "price")) == [
        ("O1", "B1", 2, 69.0), ("O1", "B2", 1, 10.0), ("O2", "B1", 4, 69.0)]
    stats = layers.author_stats(lines, "order_timestamp", "order_id", "line_quantity")
    assert rows_of(stats.select("author", "orders_count", "avg_quantity")) == [("A", 2, 3.0), ("Z", 1, 1.0)]


def test_orders_take_the_newest_customer_image(spark, area):
    fields = "order_id string, customer_id string"
    spark.createDataFrame([("O1", "C1"), ("O2", "C2"), ("O3", "C9")], fields).write.parquet(f"{area}/orders")
    feed = "customer_id string, city string, _change_type string, _commit_version bigint, _commit_timestamp bigint"
    changes = [("C1", "Lyon", "insert", 1, 10), ("C1", "Lyon", "update_preimage", 2, 20),
               ("C1", "Paris", "update_postimage", 2, 20), ("C2", "Pune", "insert", 1, 10)]
    customers = KeyedLog(f"{area}/customers", spark.createDataFrame([], "customer_id string, city string").schema,
                         ("customer_id",), ("city",))
    timed = lambda rows: spark.createDataFrame(rows, feed).withColumn("_commit_timestamp", F.timestamp_seconds("_commit_timestamp"))
    customers.put(timed(changes), customers.changes_path, 0)
    stored = KeyedLog(f"{area}/stored", spark.createDataFrame([], fields).schema, ("order_id", "customer_id"),
                      bucket_by=("customer_id",))
    joined = KeyedLog(f"{area}/joined", spark.createDataFrame(
        [], f"{fields}, city string, processed_version bigint, processed_timestamp timestamp").schema,
        ("order_id", "customer_id"), ("processed_version", "processed_timestamp"))

    def run():
        layers.orders_customers_into(
            spark.readStream.schema(fields).parquet(f"{area}/orders"), customers.stream_changes(spark), customers, stored,
            joined, "customer_id", f"{area}/marks")
        return rows_of(joined.read(spark).withColumn("processed_timestamp", F.unix_seconds("processed_timestamp")))

    assert run() == [("O1", "C1", "Paris", 2, 20), ("O2", "C2", "Pune", 1, 10)]
    late = [("C2", "Delhi", "update_postimage", 3, 5), ("C9", "Oslo", "insert", 3, 5)]
    customers.put(timed(late), customers.changes_path, 1)
    spark.createDataFrame([("O4", "C1")], fields).write.mode("append").parquet(f"{area}/orders")
    assert run() == run() == [("O1", "C1", "Paris", 2, 20), ("O2", "C2", "Delhi", 3, 5), ("O3", "C9", "Oslo", 3, 5),
                              ("O4", "C1", "Paris", 2, 20)]


def test_bronze_reads_each_message_once(spark, area, shop):
    shop(1, [book("B1", 1.0, "2024-01-01T00:00:00Z")])
    feed = lambda: raw_feed(spark, f"{area}/landing", streaming=True)
    for _ in range(2):
        layers.bronze(feed(), RETAIL, f"{area}/out", f"{area}/marks")
    assert layers.bronze_topic(spark, f"{area}/out", RETAIL["books"]).count() == 1
    assert json.loads(raw_feed(spark, f"{area}/landing").first().value)["book_id"] == "B1"


def test_one_file_per_micro_batch_drops_what_the_trailing_watermark_says(spark, area):
    """Consecutive micro-batches filter with the watermark of the batch before."""
    loads = [[(1, "2024-01-01 00:10:00", 0), (2, "2024-01-01 00:01:00", 0)],
             [(3, "2024-01-01 00:05:00", 1), (4, "2024-01-01 00:20:00", 1)],
             [(5, "2024-01-01 00:05:00", 2), (6, "2024-01-01 00:09:30", 2), (7, "2024-01-01 00:09:31", 2)]]
    for number, rows in enumerate(loads):
        land(spark, f"{area}/in", rows)
    files = sorted((f for f in os.listdir(f"{area}/in") if f.startswith("part")),
                   key=lambda f: os.stat(f"{area}/in/{f}").st_mtime_ns)
    for second, name in enumerate(files):
        os.utime(f"{area}/in/{name}", (1_700_000_000 + second, 1_700_000_000 + second))
    rows = spark.readStream.schema(TIMED).option("maxFilesPerTrigger", 1).parquet(f"{area}/in")
    run_stream(dedup_stream(rows, ["id", "ts"], "ts", "30 seconds"), f"{area}/out", f"{area}/marks")
    assert [r[0] for r in rows_of(spark.read.parquet(f"{area}/out"))] == [1, 2, 3, 4, 7]


def test_feed_files_taken_one_per_batch(spark, area, shop):
    for number in (1, 2, 3):
        shop(number, [book(f"B{number}", 1.0, "2024-01-01T00:00:00Z")])
    feed = raw_feed(spark, f"{area}/landing", streaming=True, files_per_batch=1)
    append_batches(feed.select("key"), f"{area}/out", f"{area}/marks")
    assert sorted(r[0] for r in read_batches(spark, f"{area}/out").select("batch_id").collect()) == [0, 1, 2]


def test_refreshed_intervals_equal_a_read_of_the_log(spark, area):
    def run():
        changes = spark.readStream.schema(TIMED).parquet(f"{area}/in")
        layers.scd2_stream_into(changes, ["id"], "ts", f"{area}/log", f"{area}/marks")
        return layers.refresh_scd2(spark, f"{area}/log", f"{area}/table", ["id"], "ts")

    land(spark, f"{area}/in", [(1, "2024-01-01 00:10:00", 1), (2, "2024-01-01 00:10:00", 1)])
    assert run().count() == 2
    land(spark, f"{area}/in", [(1, "2024-01-01 00:05:00", 2), (1, "2024-01-01 00:10:00", 1), (3, "2024-01-01 00:01:00", 3)])
    key = lambda df: sorted(map(repr, df.select("id", "v", "start_date", "end_date", "is_active").collect()))
    table = run()
    assert table.count() == 4
    assert key(table) == key(layers.scd2_table(spark, f"{area}/log", ["id"], "ts"))
    assert key(run()) == key(table)
    again = IntervalTable(f"{area}/table", ("id",), "ts")
    assert key(again.current(spark)) == key(table.where("is_active"))
    at = F.lit("2024-01-01 00:07:00").cast("timestamp")
    assert key(again.as_of(spark, at)) == key(as_of(table, at))


def spoil(paths):
    """Overwrite files with what no reader accepts."""
    for path in paths:
        path = path.removeprefix("file://").removeprefix("file:")
        with open(path, "wb") as f:
            f.write(b"no parquet at all")
        crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.remove(crc)


def interval_table(spark, area, rows, file_rows=5):
    """A table of three refreshes, its log folder, and what brings in more rows."""
    table = IntervalTable(f"{area}/table", ("id",), "ts", buckets=4, file_rows=file_rows)

    def bring(number, more):
        df = spark.createDataFrame(more, "id bigint, t string, v bigint")
        write_batch(df.select("id", F.col("t").cast("timestamp").alias("ts"), "v"), f"{area}/log", number)
        return table.refresh(spark, f"{area}/log")

    for number, part in enumerate(rows):
        bring(number, part)
    return table, bring


def test_a_refresh_opens_only_files_that_the_batch_can_touch(spark, area):
    """Files of other buckets, and closed files that end before the batch begins, may be broken: none is read."""
    days = [[(i, f"2024-01-{d:02d} 00:00:00", d) for i in range(40)] for d in range(1, 7)]
    table, bring = interval_table(spark, area, days)
    before = table.files(spark)
    key = spark.createDataFrame([(7,)], "id bigint")
    bucket = touched_buckets(key, ["id"], 4)[0]
    closed = [f for f in before if f.state == "closed" and f.key_bucket == bucket]
    early = [f for f in closed if f.last_end <= datetime(2024, 1, 4)]
    assert 0 < len(early) < len(closed)
    elsewhere = [f for f in before if f.key_bucket != bucket]
    spoil([f.file for f in early + elsewhere])
    bring(6, [(7, "2024-01-05 12:00:00", 99), (7, "2024-01-09 00:00:00", 100), (None, "2024-01-01 00:00:00", 0)])
    after = {f.file for f in table.files(spark)}
    assert {f.file for f in early + elsewhere} <= after and not {f.file for f in closed} <= after
    new = [f.file for f in table.files(spark) if f.file not in {b.file for b in before}]
    mine = spark.read.parquet(*new).where("id = 7 AND start_date >= '2024-01-05'")
    assert rows_of(mine.select("v", F.date_format("start_date", "dd HH"), "is_active")) == [
        (5, "05 00", False), (6, "06 00", False), (99, "05 12", False), (100, "09 00", True)]


def test_intervals_from_any_split_into_batches_equal_one_build(spark, area):
    rng = random.Random(5)
    rows = [(rng.randrange(12) if rng.random() < 0.95 else None, f"2024-01-01 00:{rng.randrange(60):02d}:00", n % 3) for n in range(180)]
    parts = [rows[a : a + 60] for a in range(0, 180, 60)]
    table, bring = interval_table(spark, area, [*parts, parts[1]], file_rows=3)
    whole = spark.createDataFrame(rows, "id bigint, t string, v bigint").select("id", F.col("t").cast("timestamp").alias("ts"), "v")
    text = lambda df: sorted(map(repr, df.select("id", "v", "start_date", "end_date", "is_active").collect()))
    want = scd2_build(whole, ["id"], "ts")
    assert text(table.read(spark)) == text(want) and text(table.current(spark)) == text(current_rows(want))
    for minute in (17, 59):
        at = F.lit(f"2024-01-01 00:{minute:02d}:30").cast("timestamp")
        assert text(table.as_of(spark, at)) == text(as_of(want, at))
    assert max(f.n_rows for f in table.files(spark)) <= 3


def test_a_refresh_that_stopped_before_its_manifest_is_done_again(spark, area):
    table, bring = interval_table(spark, area, [[(1, "2024-01-01 00:00:00", 1)], [(1, "2024-01-02 00:00:00", 2)]])
    shutil.rmtree(f"{area}/table/manifest/refresh=1")
    again = table.refresh(spark, f"{area}/log")
    assert rows_of(again.select("v", "is_active")) == [(1, False), (2, True)]
    assert rows_of(table.refresh(spark, f"{area}/log").select("v", "is_active")) == [(1, False), (2, True)]


@pytest.mark.parametrize("compacted", [False, True])
def test_a_keyed_lookup_opens_only_the_buckets_of_its_keys(spark, area, compacted):
    """Every file of the other buckets is broken; lookup, tracked batch and change lookup go through."""
    table = KeyedLog(f"{area}/table", spark.createDataFrame([], PAIR).schema, ("k",), ("v",), buckets=4)
    for number in range(3):
        table.track(spark.range(200).select(F.col("id").alias("k"), (F.col("id") + number).alias("v")), number)
    if compacted:
        table.compact(spark)
        table.track(spark.createDataFrame([(11, 1000)], PAIR), 3)
    some = spark.createDataFrame([(11, 2_000)], PAIR)
    mine = touched_buckets(some, ["k"], 4)[0]
    spoil([f"{d}/{f}" for d, _, names in os.walk(f"{area}/table") for f in names
           if f.endswith(".parquet") and "key_bucket=" in d and f"key_bucket={mine}" not in d])
    last = 1000 if compacted else 13
    assert rows_of(table.read_for(some)) == [(11, last)]
    assert table.changes_for(some).where("_change_type <> 'update_preimage'").count() == (4 if compacted else 3)
    table.track(some, 4)
    fresh = read_batches(spark, table.changes_path, schema=table.feed_schema).where(f"key_bucket = {mine} AND batch_id = 4")
    assert rows_of(fresh.select("_change_type", "k", "v")) == [("update_postimage", 11, 2000), ("update_preimage", 11, last)]
    with pytest.raises(Exception, match="(?i)parquet"):
        table.read(spark).collect()


def test_a_replay_after_compaction_gives_its_changes_again(spark, area):
    table = KeyedLog(f"{area}/table", spark.createDataFrame([], PAIR).schema, ("k",), ("v",))
    for number, rows in enumerate([[(1, 1), (2, 2)], [(1, 5), (3, 3)]]):
        table.track(spark.createDataFrame(rows, PAIR), number)
    before = rows_of(read_batches(spark, table.changes_path).drop("_commit_timestamp", "key_bucket"))
    table.compact(spark)
    table.track(spark.createDataFrame([(1, 5), (3, 3)], PAIR), 1)
    assert rows_of(read_batches(spark, table.changes_path).drop("_commit_timestamp", "key_bucket")) == before
    assert rows_of(table.read(spark)) == [(1, 5), (2, 2), (3, 3)]


@pytest.mark.parametrize("name", ["late_rows", "late_rows_in_batches"])
def test_rows_of_the_last_load_are_judged_by_the_stream(spark, area, name):
    """'error' rows come last; those of the last ten minutes are not late, those before are."""
    days = [("view", "2024-01-02 00:00:00"), ("view", "2024-01-15 12:00:00"), ("error", "2024-01-15 11:55:00"),
            ("error", "2024-01-03 00:00:00"), ("view", "2024-01-20 00:00:00"), ("error", "2024-01-18 00:00:00"),
            ("error", "2024-01-30 23:40:00"), ("view", "2024-01-30 23:59:00"), ("error", "2024-01-30 23:52:00"),
            ("error", "2024-01-30 23:59:30")]
    rows = [(i, t, 1, kind, 1.0) for i, (kind, t) in enumerate(days)]
    spark.createDataFrame(rows, "event_id bigint, ts string, user_id bigint, event_type string, value double").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{area}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{area}/events.parquet/*.parquet')")
    found = QUERIES[name](spark, area)
    assert differences(found, SQL[name], con) == []
    if name == "late_rows_in_batches":
        assert rows_of(found.select("event_id")) == [(3,), (5,), (6,)]
