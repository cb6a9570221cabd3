"""Layered tables end to end: feed to raw topic tables, to cleaned tables, to joins and aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierflow.operators.changes import newest_images
from tierflow.operators.scd import current_rows, scd1_build, scd2_build
from tierflow.operators.shape import lookup_join, order_lines
from tierflow.operators.skew import greatest_row
from tierflow.sources.feed import rejected_rows, sort_out, topic_rows
from tierflow.sources.registry import Topic
from tierflow.sources.tables import read_batches
from tierflow.streaming.intervals import IntervalTable
from tierflow.streaming.operators import dedup_stream, tumbling_stats
from tierflow.streaming.rollups import JoinedStats
from tierflow.streaming.sinks import BUCKETS, KeyedLog, append_batches, each_batch, found, log_stream

# Event-time limits of the order de-duplication and of the author statistics.
ORDER_DELAY = "30 seconds"
STATS_DELAY, STATS_WIDTH = "10 minutes", "5 minutes"
#: Partition of the bronze table for rows that no topic takes.
QUARANTINE = "quarantine"


def bronze(feed: DataFrame, registry: Mapping[str, Topic], path: str, checkpoint: str) -> StreamingQuery:
    """Feed stream to one bronze table, each message read, parsed and written once.

    A row keeps the message as it came, with a struct for its topic; rows are partitioned by the table they belong to,
    so `bronze_topic` and `bronze_quarantine` read only theirs, and `bronze_feed` gives all messages back. Bound a run's
    micro-batches with `files_per_batch` on the feed.
    """

    def shape(batch: DataFrame) -> DataFrame:
        home = F.when(F.col("reason").isNull(), F.col("topic")).otherwise(QUARANTINE)
        return sort_out(batch, registry).withColumn("table", home)

    return append_batches(feed, path, checkpoint, partition_by=["table"], prepare=shape)


def bronze_feed(spark: SparkSession, path: str) -> DataFrame:
    """All messages as they came."""
    return read_batches(spark, path).select("topic", "key", "value", "create_ts", "source_file", "insert_ts")


def bronze_topic(spark: SparkSession, path: str, topic: Topic, streaming: bool = False) -> DataFrame:
    """Rows of one topic's table, bounded or as a stream."""
    rows = read_batches(spark, path)
    if streaming:
        schema = rows.drop("batch_id", "table").schema
        rows = spark.readStream.schema(schema).parquet(f"{path}/query=*/batch_id=*/table={topic.name}")
    else:
        rows = rows.where(F.col("table") == topic.name)
    return topic_rows(rows, topic.name, ("key", "create_ts"))


def bronze_quarantine(spark: SparkSession, path: str) -> DataFrame:
    return rejected_rows(read_batches(spark, path).where(F.col("table") == QUARANTINE))


def scd1_stream_into(
    changes: DataFrame,
    table: KeyedLog,
    checkpoint: str,
    include_ops: Sequence[str] | None = None,
    op_col: str | None = None,
    track: bool = False,
) -> StreamingQuery:
    """Keep the latest row per key of a change stream; with `track` its change feed as well."""

    def latest(batch: DataFrame) -> DataFrame:
        return scd1_build(batch, table.keys, table.order_by[0], include_ops, op_col)

    return log_stream(changes, table, checkpoint, track, latest)


def scd2_stream_into(
    changes: DataFrame, keys: Sequence[str], sequence_by: str, path: str, checkpoint: str
) -> StreamingQuery:
    """Append each micro-batch's distinct changes; `scd2_table` reads them as intervals.

    A micro-batch costs its own rows only, however long the history of the keys it touches.
    """
    return append_batches(changes, path, checkpoint, prepare=lambda b: greatest_row(b, [*keys, sequence_by]))


def scd2_table(
    spark: SparkSession, path: str, keys: Sequence[str], sequence_by: str, open_end: Column | None = None
) -> DataFrame:
    return scd2_build(read_batches(spark, path).drop("batch_id"), keys, sequence_by, open_end)


def refresh_scd2(
    spark: SparkSession, log_path: str, table_path: str, keys: Sequence[str], sequence_by: str, buckets: int = BUCKETS
) -> DataFrame:
    """A stored interval table brought up to the change log: the log's batches since the last refresh are applied."""
    return IntervalTable(table_path, tuple(keys), sequence_by, buckets).refresh(spark, log_path)


def clean_topics(
    spark: SparkSession, registry: Mapping[str, Topic], bronze_path: str, path: str, checkpoint: str, buckets: int = BUCKETS
) -> dict[str, DataFrame]:
    """Every topic of the bronze table brought into the table that its `scd_type` asks for, and those tables as they are.

    2: all versions as intervals; 1: the latest row of a key; none: the first row of a key, whose keys hold its time.
    """
    tables = {}
    for name, topic in registry.items():
        rows = bronze_topic(spark, bronze_path, topic, streaming=True).select(*topic.struct.names)
        place, marks = f"{path}/{name}", f"{checkpoint}/{name}"
        if topic.scd_type == 2:
            scd2_stream_into(rows, topic.keys, topic.sequence_by, f"{place}/log", marks)
            tables[name] = refresh_scd2(spark, f"{place}/log", f"{place}/table", topic.keys, topic.sequence_by, buckets)
        else:
            table = KeyedLog(place, topic.struct, topic.keys, (topic.sequence_by,), first=topic.scd_type is None, buckets=buckets)
            if topic.scd_type == 1:
                scd1_stream_into(rows, table, marks)
            else:
                orders_stream_into(rows, table, topic.sequence_by, marks)
            tables[name] = table.read(spark)
    return tables


def orders_stream_into(
    orders: DataFrame, table: KeyedLog, ts: str, checkpoint: str, delay: str = ORDER_DELAY, salts: int = 1
) -> StreamingQuery:
    """Insert each order once: state drops near repeats, the table (`first`) ignores those that come after its eviction."""
    return log_stream(dedup_stream(orders, table.keys, ts, delay, salts), table, checkpoint)


def orders_customers_into(
    orders: DataFrame, customer_changes: DataFrame, customers: KeyedLog, known_orders: KeyedLog, joined: KeyedLog,
    customer_key: str, checkpoint: str,
) -> None:
    """Orders joined with the newest image of their customer, as two streams without any join state.

    New orders meet the newest images so far; then new changes meet the stored orders of the customers they touch. Both
    lookups open the buckets of the customers in the micro-batch only, so `customers` and `known_orders` are placed by the
    customer. Either side may come first. Rows of `joined` are ordered by the commit of the customer's image.
    """
    if {customers.placed_by, known_orders.placed_by} != {(customer_key,)}:
        raise ValueError("customers and known orders must be placed by the customer key")

    def meet(orders: DataFrame, images: DataFrame) -> DataFrame:
        return orders.join(newest_images(images, [customer_key]), customer_key)

    def new_orders(batch: DataFrame, number: int) -> None:
        known_orders.append(batch, number)
        images = customers.changes_for(batch)
        if images is not None:
            joined.append(meet(batch, images.select(*customer_changes.columns)), number)

    def new_images(batch: DataFrame, number: int) -> None:
        joined.append(meet(known_orders.read_for(batch), batch), number)

    each_batch(orders, new_orders, f"{checkpoint}/orders")
    each_batch(customer_changes, new_images, f"{checkpoint}/customers")


def joined_stats_into(fact_changes: DataFrame, dimension_changes: DataFrame, kept: JoinedStats, checkpoint: str) -> None:
    """Statistics of a join kept by the change feeds of both sides, one after the other."""
    each_batch(fact_changes, kept.fact_changes, f"{checkpoint}/facts")
    each_batch(dimension_changes, kept.dimension_changes, f"{checkpoint}/dimension")


def keep_current(scd2: DataFrame, path: str) -> DataFrame:
    """Replace the stored current rows of an interval table: a new version folder, listed when it is whole."""
    spark = scd2.sparkSession
    done = found(lambda: spark.read.parquet(f"{path}/versions"))
    version = 0 if done is None else done.agg(F.max("version")).first()[0] + 1
    current_rows(scd2).write.mode("overwrite").parquet(f"{path}/rows/version={version}")
    spark.range(1).select(F.lit(version).alias("version")).coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return kept_current(spark, path)


def kept_current(spark: SparkSession, path: str) -> DataFrame:
    version = spark.read.parquet(f"{path}/versions").agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{path}/rows/version={version}")


def customers_with_country(customers: DataFrame, countries: DataFrame) -> DataFrame:
    joined = lookup_join(customers, countries, "country_code", "code")
    return joined.drop("country_code", "code")


def orders_books(orders: DataFrame, current_books: DataFrame) -> DataFrame:
    """Order lines, bounded or a stream, with the current version of their book."""
    books = current_books.select("book_id", "title", "author", "price")
    return order_lines(orders, books, "books", "book_id", "book_id")


def author_stats(
    lines: DataFrame, ts: str, order_col: str, quantity_col: str, delay: str | None = None
) -> DataFrame:
    """Order lines and mean quantity per author and window."""
    stats = tumbling_stats(lines, ts, STATS_WIDTH, ["author"], order_col, quantity_col, delay)
    return stats.withColumnsRenamed({"n_rows": "orders_count", "avg_value": "avg_quantity"})


def reconcile(
    feed_a: DataFrame, feed_b: DataFrame, keys: Sequence[str], order_by: str, label_col: str
) -> DataFrame:
    """Per feed: rows, distinct keys, and rows that are the latest of their key over both feeds.

    Counts only, so the feeds are read once and shrink at each step: to one row per (feed, key, order value),
    then per (feed, key), of which each key has at most two to compare.
    """
    both = feed_a.withColumn(label_col, F.lit("A")).unionByName(feed_b.withColumn(label_col, F.lit("B")))
    per_value = both.groupBy(label_col, *keys, order_by).agg(F.count(F.lit(1)).alias("_n"))
    per_key = per_value.groupBy(label_col, *keys).agg(
        F.sum("_n").alias("_n"), F.max(F.struct(F.col(order_by).alias("at"), F.col("_n").alias("n"))).alias("_top")
    )
    overall = per_key.withColumn("_newest", F.max("_top.at").over(Window.partitionBy(*keys)))
    is_latest = F.col("_top.at").eqNullSafe(F.col("_newest"))
    return overall.groupBy(label_col).agg(
        F.sum("_n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.sum(F.when(is_latest, F.col("_top.n")).otherwise(0)).alias("n_latest"),
    )
