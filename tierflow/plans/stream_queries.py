"""Structured Streaming over the tables: every query runs its backlog to completion and returns the table it left.

Loads land one after the other and each is a run of its own on the same checkpoint, as in scheduled operation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierflow.operators.changes import change_feed
from tierflow.operators.scd import scd2_build
from tierflow.operators.shape import lookup_join, nest_lines, union_widened
from tierflow.plans import layers
from tierflow.plans.catalog import query
from tierflow.plans.dimension_queries import FIELDS, OPS, late_sql, latest_sql, scd2_sql
from tierflow.plans.inputs import (
    EVENT_TOPICS,
    LATE_LOAD_SQL,
    LATE_LOADS,
    LATER_LOAD_SQL,
    PAYLOAD,
    arrivals,
    landed_feed,
    load_numbers,
    loads,
)
from tierflow.session import new_area
from tierflow.sources.feed import raw_feed
from tierflow.sources.registry import registry
from tierflow.sources.tables import read_batches, read_lookup, read_table, stream_table, zoned
from tierflow.streaming.admission import Landing
from tierflow.streaming.operators import TimeBound, dedup_stream, stream_join, tumbling_stats
from tierflow.streaming.rollups import DeltaStats, JoinedStats, own_copy
from tierflow.streaming.sinks import KeyedLog, append_batches, changes_stream, keep_progress, run_stream, write_batch

# Partitions among which the copies of one key are spread.
SALTS = 4
# Files of a landed load.
FILES = 4
# Buckets of the stored tables, which are small here.
BUCKETS = 4


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def bronze_stream_events(spark: SparkSession, root: str) -> DataFrame:
    area = new_area(spark, "bronze-events")
    run_stream(stream_table(spark, root, "events"), f"{area}/table", f"{area}/marks")
    return spark.read.parquet(f"{area}/table")


@query(latest_sql("user_id", f"event_type IN {OPS}"))
def scd1_stream(spark: SparkSession, root: str) -> DataFrame:
    area = new_area(spark, "scd1")
    log = zoned(loads(spark, root, LATE_LOAD_SQL), "ts").select(*FIELDS, "load")
    table = KeyedLog(f"{area}/table", log.drop("load").schema, ("user_id",), ("ts",), buckets=BUCKETS)
    for load in arrivals(log, f"{area}/landing", LATE_LOADS):
        changes = spark.readStream.schema(log.schema).parquet(f"{area}/landing").drop("load")
        layers.scd1_stream_into(changes, table, f"{area}/marks", OPS, "event_type")
        if load == 1:
            table.compact(spark)
    return table.read(spark)


@query(scd2_sql())
def scd2_stream(spark: SparkSession, root: str) -> DataFrame:
    """Loads with late rows, each delivered twice."""
    area = new_area(spark, "scd2")
    log = loads(spark, root, LATE_LOAD_SQL).select(*FIELDS, "load")
    for _ in arrivals(log, f"{area}/landing", LATE_LOADS, copies=2):
        changes = spark.readStream.schema(log.schema).parquet(f"{area}/landing").drop("load")
        layers.scd2_stream_into(changes, ["user_id"], "ts", f"{area}/log", f"{area}/marks")
    return layers.scd2_table(spark, f"{area}/log", ["user_id"], "ts")


@query(scd2_sql())
def scd2_refresh(spark: SparkSession, root: str) -> DataFrame:
    """The interval table kept stored, brought up to the log after each late load."""
    area = new_area(spark, "scd2-refresh")
    log = loads(spark, root, LATE_LOAD_SQL).select(*FIELDS, "load")
    table = None
    for _ in arrivals(log, f"{area}/landing", LATE_LOADS):
        changes = spark.readStream.schema(log.schema).parquet(f"{area}/landing").drop("load")
        layers.scd2_stream_into(changes, ["user_id"], "ts", f"{area}/log", f"{area}/marks")
        table = layers.refresh_scd2(spark, f"{area}/log", f"{area}/table", ["user_id"], "ts", BUCKETS)
    return table


@query("SELECT o_orderkey, o_orderdate, o_custkey, o_totalprice FROM orders")
def orders_insert_only_stream(spark: SparkSession, root: str) -> DataFrame:
    """Two loads that share a year of orders, each delivered twice."""
    area = new_area(spark, "orders")
    orders = read_table(spark, root, "orders").select("o_orderkey", "o_orderdate", "o_custkey", "o_totalprice")
    old = orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    new = orders.where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    log = zoned(old.withColumn("load", F.lit(0)).unionByName(new.withColumn("load", F.lit(1))), "o_orderdate")
    table = KeyedLog(f"{area}/table", log.drop("load").schema, ("o_orderkey", "o_orderdate"), first=True, buckets=BUCKETS)
    for _ in arrivals(log, f"{area}/landing", range(2), copies=2):
        feed = spark.readStream.schema(log.schema).parquet(f"{area}/landing").drop("load")
        layers.orders_stream_into(feed, table, "o_orderdate", f"{area}/marks", salts=SALTS)
    return table.read(spark)


@query(f"""
    SELECT user_id, event_type, event_id, ts, value FROM events
    WHERE event_id NOT IN (SELECT event_id FROM ({late_sql("30 SECOND", 1)}))
""")
def stream_dedup(spark: SparkSession, root: str) -> DataFrame:
    """Each load delivered twice; rows behind the watermark of the loads before are dropped."""
    area = new_area(spark, "dedup")
    log = zoned(loads(spark, root, LATE_LOAD_SQL), "ts").select(*FIELDS, "load")
    for _ in arrivals(log, f"{area}/landing", LATE_LOADS, copies=2):
        rows = spark.readStream.schema(log.schema).parquet(f"{area}/landing").drop("load")
        single = dedup_stream(rows, ["event_id", "ts"], "ts", layers.ORDER_DELAY, salts=SALTS)
        run_stream(single, f"{area}/table", f"{area}/marks")
    return spark.read.parquet(f"{area}/table")


@query("""
    SELECT * FROM (
        SELECT time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start,
               time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') + INTERVAL 5 MINUTE AS window_end,
               event_type, count(*) AS n_rows, round(avg(value), 6) AS avg_value
        FROM events GROUP BY ALL
    ) WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
""")
def tumbling_stats_stream(spark: SparkSession, root: str) -> DataFrame:
    """Windows that the watermark has closed; the last ones stay open for rows to come."""
    area = new_area(spark, "tumbling")
    log = zoned(loads(spark, root), "ts").select(*FIELDS, "load")
    for _ in arrivals(log, f"{area}/landing", range(3)):
        rows = spark.readStream.schema(log.schema).parquet(f"{area}/landing")
        stats = tumbling_stats(
            rows, "ts", layers.STATS_WIDTH, ["event_type"], "event_id", "value", layers.STATS_DELAY
        )
        run_stream(stats, f"{area}/table", f"{area}/marks")
    return spark.read.parquet(f"{area}/table").withColumn("avg_value", F.round("avg_value", 6))


def _late(spark: SparkSession, root: str, label: str, schedule: str, delay: str, at_once: bool) -> DataFrame:
    """The rows that a stream's own watermark drops, found by what its output lacks."""
    area = new_area(spark, label)
    log = zoned(loads(spark, root, schedule), "ts").select(*FIELDS, "load")
    numbers, landing = load_numbers(log), Landing(f"{area}/landing")
    for load in numbers:
        landing.land(log.where(F.col("load") == load), load, FILES)
        if at_once and load < numbers[-1]:
            continue
        source = spark.readStream.schema(log.schema)
        source = source.option("maxFilesPerTrigger", FILES) if at_once else source
        kept = dedup_stream(source.parquet(landing.files), ["event_id", "ts"], "ts", delay)
        run_stream(kept, f"{area}/table", f"{area}/marks")
    if not numbers:
        return log
    landed = spark.read.schema(log.schema).parquet(landing.files)
    return landed.join(spark.read.parquet(f"{area}/table").select("event_id"), "event_id", "left_anti").select(*FIELDS, "load")


@query(late_sql("30 SECOND", 1))
def late_rows(spark: SparkSession, root: str) -> DataFrame:
    """Each load is a run of its own, filtered with the watermark that the runs before left."""
    return _late(spark, root, "late", LATE_LOAD_SQL, layers.ORDER_DELAY, at_once=False)


@query(f"""
    SELECT load, count(late.event_id) AS n_dropped FROM (SELECT DISTINCT CAST({LATE_LOAD_SQL} AS BIGINT) AS load FROM events)
    LEFT JOIN ({late_sql("30 SECOND", 1)}) late USING (load) GROUP BY load
""")
def late_rows_dropped(spark: SparkSession, root: str) -> DataFrame:
    """How many rows each load's run dropped, as the stream's own metric tells."""
    area = new_area(spark, "dropped")
    log = zoned(loads(spark, root, LATE_LOAD_SQL), "ts").select(*FIELDS, "load")
    told = []
    for load in arrivals(log, f"{area}/landing", load_numbers(log)):
        rows = spark.readStream.schema(log.schema).parquet(f"{area}/landing")
        kept = dedup_stream(rows, ["event_id", "ts"], "ts", layers.ORDER_DELAY)
        keep_progress(run_stream(kept, f"{area}/table", f"{area}/marks"), f"{area}/progress/load={load}")
        told.append(load)
    if not told:
        return log.groupBy("load").agg(F.count(F.lit(1)).alias("n_dropped"))
    progress = spark.read.parquet(f"{area}/progress")
    return progress.groupBy(F.col("load").cast("bigint").alias("load")).agg(F.sum("rows_dropped").alias("n_dropped"))


@query(late_sql("10 MINUTE", 2, LATER_LOAD_SQL))
def late_rows_in_batches(spark: SparkSession, root: str) -> DataFrame:
    """The loads are consecutive micro-batches of one run, where the filter trails one batch."""
    return _late(spark, root, "late-batches", LATER_LOAD_SQL, "10 minutes", at_once=True)


@query("SELECT c_custkey, c_name, n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey")
def stream_static_lookup(spark: SparkSession, root: str) -> DataFrame:
    area = new_area(spark, "lookup")
    customers = stream_table(spark, root, "customer")
    joined = lookup_join(customers, read_table(spark, root, "nation"), "c_nationkey", "n_nationkey")
    run_stream(joined.select("c_custkey", "c_name", F.col("n_name").alias("country")), f"{area}/table", f"{area}/marks")
    return spark.read.parquet(f"{area}/table")


@query("SELECT c_custkey, c_name, n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey")
def stream_json_lookup(spark: SparkSession, root: str) -> DataFrame:
    """Customers with the country that a JSON lookup names for their code."""
    area = new_area(spark, "json-lookup")
    nations = read_table(spark, root, "nation")
    nations.select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("country")).write.json(f"{area}/countries")
    countries = read_lookup(spark, f"{area}/countries", "code BIGINT, country STRING")
    customers = stream_table(spark, root, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("country_code"))
    run_stream(layers.customers_with_country(customers, countries), f"{area}/table", f"{area}/marks")
    return spark.read.parquet(f"{area}/table")


@query("""
    SELECT a.event_id, a.user_id, a.ts, b.event_id AS other_id, b.ts AS other_ts
    FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'purchase' AND b.event_type = 'click'
        AND b.ts BETWEEN a.ts - INTERVAL 1 HOUR AND a.ts + INTERVAL 1 HOUR
""")
def stream_stream_join(spark: SparkSession, root: str) -> DataFrame:
    """Purchases with the user's clicks within an hour; state expires a month behind."""
    area = new_area(spark, "stream-join")
    rows = zoned(stream_table(spark, root, "events"), "ts")
    purchases = rows.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = rows.where("event_type = 'click'").select(
        F.col("event_id").alias("other_id"), "user_id", F.col("ts").alias("other_ts")
    )
    bound = TimeBound("ts", "other_ts", delay="31 days", within="1 hour")
    run_stream(stream_join(purchases, clicks, ["user_id"], bound, salts=SALTS), f"{area}/table", f"{area}/marks")
    return spark.read.parquet(f"{area}/table")


@query("""
    SELECT o_orderkey, o_custkey, o_totalprice, c_name,
           CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE 'UNKNOWN' END AS c_mktsegment
    FROM orders JOIN customer ON o_custkey = c_custkey
""")
def orders_customers_stream(spark: SparkSession, root: str) -> DataFrame:
    """Orders follow the change feed of the customers table: a second load of customers corrects the first."""
    area = new_area(spark, "orders-customers")
    known = read_table(spark, root, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment",
                                                       "c_acctbal")
    first = known.withColumn("c_mktsegment", F.lit("UNKNOWN")).withColumn("load", F.lit(0))
    log = first.unionByName(known.where("c_acctbal > 0").withColumn("load", F.lit(1))).drop("c_acctbal")
    customers = KeyedLog(f"{area}/customers", log.schema, ("o_custkey",), ("load",), buckets=BUCKETS)
    orders = stream_table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    fields = "o_orderkey bigint, o_custkey bigint, o_totalprice double"
    stored = KeyedLog(f"{area}/orders", StructType.fromDDL(fields), ("o_orderkey", "o_custkey"), bucket_by=("o_custkey",), buckets=BUCKETS)
    joined = KeyedLog(
        f"{area}/joined",
        StructType.fromDDL(
            f"{fields}, c_name string, c_mktsegment string, processed_version bigint, processed_timestamp timestamp"
        ),
        ("o_orderkey", "o_custkey"),
        ("processed_version", "processed_timestamp"), buckets=BUCKETS,
    )
    for _ in arrivals(log, f"{area}/landing", range(2)):
        loaded = spark.readStream.schema(log.schema).parquet(f"{area}/landing")
        layers.scd1_stream_into(loaded, customers, f"{area}/marks-customers", track=True)
        changes = customers.stream_changes(spark).drop("load")
        layers.orders_customers_into(orders, changes, customers, stored, joined, "o_custkey", f"{area}/marks-joined")
    return joined.read(spark).drop("processed_version", "processed_timestamp")


@query("SELECT event_type AS topic, event_id, user_id, value FROM events")
def feed_fanout(spark: SparkSession, root: str) -> DataFrame:
    """One partitioned write per micro-batch for all topics."""
    area = new_area(spark, "fanout")
    feed = raw_feed(spark, landed_feed(spark, root, "fanout"), streaming=True)
    append_batches(feed, f"{area}/table", f"{area}/marks", partition_by=["topic"])
    payload = F.from_json("value", "event_id BIGINT, user_id BIGINT, value DOUBLE").alias("v")
    return read_batches(spark, f"{area}/table").select("topic", payload).select("topic", "v.*")


def _bronze(spark: SparkSession, root: str, label: str) -> str:
    """A bronze table of the feed, a few files per micro-batch."""
    area = new_area(spark, label)
    feed = raw_feed(spark, landed_feed(spark, root, label), streaming=True, files_per_batch=4)
    topics = {name: topic for name, topic in EVENT_TOPICS.items() if name != "error"}
    layers.bronze(feed, topics, f"{area}/bronze", f"{area}/marks")
    return f"{area}/bronze"


@query("SELECT event_type AS topic, event_id, ts, user_id, value FROM events WHERE event_type <> 'error'")
def bronze_topics(spark: SparkSession, root: str) -> DataFrame:
    """Feed to topic tables, each message read once."""
    path = _bronze(spark, root, "bronze")
    tables = [
        layers.bronze_topic(spark, path, topic).select(F.lit(name).alias("topic"), "event_id", "ts", "user_id", "value")
        for name, topic in EVENT_TOPICS.items() if name != "error"
    ]
    return union_widened(*tables)


@query("""
    SELECT 'feed' AS kind, event_type AS topic, CAST(user_id AS VARCHAR) AS key, event_id FROM events
    UNION ALL SELECT 'topic', event_type, CAST(user_id AS VARCHAR), event_id FROM events WHERE event_type <> 'error'
    UNION ALL SELECT 'quarantine: unknown topic', event_type, CAST(user_id AS VARCHAR), event_id FROM events
    WHERE event_type = 'error'
""")
def pipeline_bronze(spark: SparkSession, root: str) -> DataFrame:
    """All messages as they came, the topics' rows and the quarantine, from one table."""
    path = _bronze(spark, root, "pipeline-bronze")
    event_id = F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id")
    topics = [
        layers.bronze_topic(spark, path, topic).select(F.lit("topic").alias("kind"), F.lit(name).alias("topic"), "key", "event_id")
        for name, topic in EVENT_TOPICS.items() if name != "error"
    ]
    return union_widened(
        layers.bronze_feed(spark, path).select(F.lit("feed").alias("kind"), "topic", "key", event_id),
        *topics,
        layers.bronze_quarantine(spark, path).select(
            F.concat(F.lit("quarantine: "), "reason").alias("kind"), "topic", "key", event_id
        ),
    )


#: One topic of each kind: all versions, the latest row, the first row.
BY_KIND = registry([
    {"name": "click", "schema": PAYLOAD, "keys": ["user_id"], "sequence_by": "ts", "scd_type": 2, "required": ["event_id", "ts"]},
    {"name": "purchase", "schema": PAYLOAD, "keys": ["user_id"], "sequence_by": "ts", "scd_type": 1, "required": ["event_id", "ts"]},
    {"name": "view", "schema": PAYLOAD, "keys": ["event_id", "ts"], "sequence_by": "ts", "required": ["event_id", "ts"]},
])


@query("""
    SELECT 'click' AS topic, event_id, user_id, value, ts AS start_date,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS end_date FROM events WHERE event_type = 'click'
    UNION ALL
    SELECT 'purchase', event_id, user_id, value, ts, NULL FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS place FROM events WHERE event_type = 'purchase'
    ) WHERE place = 1
    UNION ALL
    SELECT 'view', event_id, user_id, value, ts, NULL FROM events WHERE event_type = 'view'
""")
def clean_by_registry(spark: SparkSession, root: str) -> DataFrame:
    """Feed to bronze to the kind of table that each topic's configuration names."""
    area = new_area(spark, "by-registry")
    feed = raw_feed(spark, landed_feed(spark, root, "by-registry"), streaming=True)
    layers.bronze(feed, BY_KIND, f"{area}/bronze", f"{area}/marks/bronze")
    tables = layers.clean_topics(spark, BY_KIND, f"{area}/bronze", f"{area}/clean", f"{area}/marks", BUCKETS)
    shown = [
        df.withColumnRenamed("ts", "start_date").withColumn("topic", F.lit(name)).drop("props", "is_active") for name, df in tables.items()
    ]
    return union_widened(*shown)


def _order_messages(spark: SparkSession, root: str) -> DataFrame:
    """Orders with nested lines, as order messages carry them."""
    lines = read_table(spark, root, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").alias("number"), F.col("l_partkey").alias("book_id"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("subtotal"),
    )
    books = nest_lines(lines, ["l_orderkey"], ["book_id", "quantity", "subtotal"], "number", "books")
    orders = read_table(spark, root, "orders").select("o_orderkey", "o_orderdate")
    return zoned(orders.join(books, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey"), "o_orderdate")


def _current_books(spark: SparkSession, root: str, path: str) -> DataFrame:
    """Parts as books whose price changed once, kept as a stored table of current versions that is replaced once."""
    parts = read_table(spark, root, "part").select(
        F.col("p_partkey").alias("book_id"), F.col("p_name").alias("title"), F.col("p_brand").alias("author"),
        F.col("p_retailprice").alias("price"),
    )
    old = parts.withColumn("price", F.lit(0.0)).withColumn("updated", F.lit("2024-01-01").cast("timestamp_ntz"))
    new = parts.withColumn("updated", F.lit("2024-02-01").cast("timestamp_ntz"))
    layers.keep_current(scd2_build(old, ["book_id"], "updated"), path)
    return layers.keep_current(scd2_build(old.unionByName(new), ["book_id"], "updated"), path)


@query("""
    SELECT o_orderkey, l_linenumber AS line_number, l_partkey AS line_book_id, l_quantity AS line_quantity,
           l_extendedprice AS line_subtotal, p_name AS title, p_brand AS author, p_retailprice AS price
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
""")
def order_lines_stream(spark: SparkSession, root: str) -> DataFrame:
    """A stream of orders, its lines joined with the stored current books."""
    area = new_area(spark, "order-lines")
    messages = _order_messages(spark, root)
    messages.write.parquet(f"{area}/landing")
    books = _current_books(spark, root, f"{area}/books")
    orders = spark.readStream.schema(messages.schema).parquet(f"{area}/landing")
    run_stream(layers.orders_books(orders, books).drop("o_orderdate", "book_id"), f"{area}/table", f"{area}/marks")
    return spark.read.parquet(f"{area}/table")


@query("""
    SELECT * FROM (
        SELECT time_bucket(INTERVAL 5 MINUTE, o_orderdate, TIMESTAMP '1970-01-01') AS window_start,
               time_bucket(INTERVAL 5 MINUTE, o_orderdate, TIMESTAMP '1970-01-01') + INTERVAL 5 MINUTE AS window_end,
               p_brand AS author, count(*) AS orders_count, round(avg(l_quantity), 6) AS avg_quantity
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
        GROUP BY ALL
    ) WHERE window_end <= (SELECT max(o_orderdate) - INTERVAL 10 MINUTE FROM orders)
""")
def author_stats_stream(spark: SparkSession, root: str) -> DataFrame:
    """Statistics per author and closed window over a stream of order lines."""
    area = new_area(spark, "author-stats")
    messages = _order_messages(spark, root)
    messages.write.parquet(f"{area}/landing")
    orders = spark.readStream.schema(messages.schema).parquet(f"{area}/landing")
    lines = layers.orders_books(orders, _current_books(spark, root, f"{area}/books"))
    stats = layers.author_stats(lines, "o_orderdate", "o_orderkey", "line_quantity", layers.STATS_DELAY)
    run_stream(stats, f"{area}/table", f"{area}/marks")
    return spark.read.parquet(f"{area}/table").withColumn("avg_quantity", F.round("avg_quantity", 6))


LINE = "o_orderkey bigint, line int, book_id bigint, window_start timestamp, line_quantity double"
BOOK = "book_id bigint, author string"
LAST_AUTHOR = "CASE WHEN p_size <= 10 THEN 'Revised' ELSE p_brand END"


def _line_changes(spark: SparkSession, root: str) -> list[DataFrame]:
    """All lines but those numbered 7; then these come, quantities and books of others change, and some go."""
    orders = zoned(read_table(spark, root, "orders"), "o_orderdate").select("o_orderkey", "o_orderdate")
    lines = read_table(spark, root, "lineitem")
    # Numbers repeat within an order; the place among its lines does not.
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*[c for c in lines.columns if c != "l_orderkey"]))
    rows = lines.withColumn("line", place).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_orderkey", "line", F.col("l_partkey").alias("book_id"),
        F.window("o_orderdate", layers.STATS_WIDTH)["start"].alias("window_start"), F.col("l_quantity").alias("line_quantity"),
        F.col("l_linenumber").alias("number"),
    )
    number, quantity = F.col("number"), F.col("line_quantity")
    first = rows.where("number <> 7").drop("number")
    last = rows.where("number <> 3").withColumns({
        "line_quantity": F.when(number == 2, quantity + 10).otherwise(quantity),
        "book_id": F.when(number == 4, F.lit(1)).otherwise(F.col("book_id")),
    }).drop("number")
    keys = ["o_orderkey", "line"]
    return [change_feed(first.limit(0), first, keys, 0), change_feed(first, last, keys, 1)]


@query(f"""
    SELECT time_bucket(INTERVAL 5 MINUTE, o_orderdate, TIMESTAMP '1970-01-01') AS window_start, {LAST_AUTHOR} AS author,
           count(*) AS orders_count,
           round(avg(CASE WHEN l_linenumber = 2 THEN l_quantity + 10 ELSE l_quantity END), 6) AS avg_quantity
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    JOIN part ON p_partkey = CASE WHEN l_linenumber = 4 THEN 1 ELSE l_partkey END
    WHERE l_linenumber <> 3 AND p_size <> 50 GROUP BY 1, 2
""")
def author_stats_deltas(spark: SparkSession, root: str) -> DataFrame:
    """Author statistics kept through inserts, updates, moves and deletes on both sides, by reading the changes alone."""
    area = new_area(spark, "author-deltas")
    groups = StructType.fromDDL("window_start timestamp, author string")
    line, book = StructType.fromDDL(LINE), StructType.fromDDL(BOOK)
    kept = JoinedStats(
        DeltaStats(f"{area}/stats", groups),
        own_copy(f"{area}/lines", line, ("o_orderkey", "line", "book_id"), "book_id", BUCKETS),
        own_copy(f"{area}/books", book, ("book_id",), "book_id", BUCKETS), "book_id", "line_quantity",
    )
    parts = read_table(spark, root, "part")
    books = parts.select(F.col("p_partkey").alias("book_id"), F.col("p_brand").alias("author"))
    revised = parts.where("p_size <> 50").select(F.col("p_partkey").alias("book_id"), F.expr(LAST_AUTHOR).alias("author"))
    book_feeds = [change_feed(books.limit(0), books, ["book_id"], 0), change_feed(books, revised, ["book_id"], 1)]
    for number, (lines, changed_books) in enumerate(zip(_line_changes(spark, root), book_feeds)):
        write_batch(lines, f"{area}/line-feed", number)
        write_batch(changed_books, f"{area}/book-feed", number)
        layers.joined_stats_into(
            changes_stream(spark, f"{area}/line-feed", line), changes_stream(spark, f"{area}/book-feed", book), kept, f"{area}/marks"
        )
        if number == 0:
            kept.stats.fold(spark)
    stats = kept.stats.read(spark)
    return stats.select("window_start", "author", F.col("n_rows").alias("orders_count"), F.round("avg_value", 6).alias("avg_quantity"))
