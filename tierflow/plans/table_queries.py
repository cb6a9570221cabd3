"""Projections, filters, joins, aggregations, orderings and set operations over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.merge import incremental_slice
from tierflow.operators.reduce import (
    SKETCH_BITS,
    count_keys,
    count_rows,
    in_given_order,
    key_sketches,
    keys_of_sketches,
    latest_per_key,
    string_agg,
)
from tierflow.operators.scd import scd1_build
from tierflow.operators.shape import lookup_join, nest_lines, order_lines, union_widened
from tierflow.operators.skew import next_sequence
from tierflow.plans.catalog import query
from tierflow.plans.inputs import LOAD_SQL, events, loads
from tierflow.plans.layers import author_stats, reconcile
from tierflow.session import new_area
from tierflow.sources.tables import read_table, zoned
from tierflow.streaming.operators import tumbling_stats

# The two feeds to reconcile: events before the first and from the second day on; they share ten days.
FEED_A_END, FEED_B_START = "2024-01-20", "2024-01-10"


def _feeds(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    rows = events(spark, root)
    return (
        rows.where(F.col("ts") < F.lit(FEED_A_END).cast("timestamp_ntz")),
        rows.where(F.col("ts") >= F.lit(FEED_B_START).cast("timestamp_ntz")),
    )


@query(f"""
    WITH both_feeds AS (
        SELECT 'A' AS feed, * FROM events WHERE ts < TIMESTAMP '{FEED_A_END}'
        UNION ALL SELECT 'B', * FROM events WHERE ts >= TIMESTAMP '{FEED_B_START}'
    ), ranked AS (
        SELECT feed, rank() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) AS place FROM both_feeds
    ), sizes AS (
        SELECT feed, count(*) AS n_rows, count(DISTINCT (user_id, event_type)) AS n_keys FROM both_feeds GROUP BY feed
    )
    SELECT s.feed, s.n_rows, s.n_keys, (SELECT count(*) FROM ranked r WHERE r.feed = s.feed AND place = 1) AS n_latest
    FROM sizes s
""")
def reconcile_feeds(spark: SparkSession, root: str) -> DataFrame:
    return reconcile(*_feeds(spark, root), keys=("user_id", "event_type"), order_by="ts", label_col="feed")


@query("SELECT c_custkey AS customer_id, upper(c_name) AS name, 'retail' AS origin FROM customer")
def project_rename_drop(spark: SparkSession, root: str) -> DataFrame:
    renamed = read_table(spark, root, "customer").withColumnRenamed("c_custkey", "customer_id")
    shaped = renamed.withColumn("name", F.upper("c_name")).withColumn("origin", F.lit("retail"))
    return shaped.drop("c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("SELECT * EXCLUDE (p_type, p_size) FROM part")
def project_except(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "part").drop("p_type", "p_size")


@query("SELECT * FROM events WHERE user_id = 7")
def filter_key(spark: SparkSession, root: str) -> DataFrame:
    return events(spark, root).where(F.col("user_id") == 7)


@query("SELECT * FROM events WHERE event_type IN ('signup', 'purchase')")
def filter_in_list(spark: SparkSession, root: str) -> DataFrame:
    return events(spark, root).where(F.col("event_type").isin("signup", "purchase"))


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem
    WHERE (l_returnflag = 'R' OR l_quantity >= 45) AND l_shipdate IS NOT NULL AND l_linestatus <> 'O'
""")
def filter_compound(spark: SparkSession, root: str) -> DataFrame:
    kept = (
        ((F.col("l_returnflag") == "R") | (F.col("l_quantity") >= 45))
        & F.col("l_shipdate").isNotNull()
        & (F.col("l_linestatus") != "O")
    )
    lines = read_table(spark, root, "lineitem")
    return lines.where(kept).select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


@query("SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'widget')")
def filter_contains(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "part").where(F.col("p_name").contains("widget")).select("p_partkey", "p_name")


@query(f"SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events WHERE {LOAD_SQL} = 0)")
def newer_than_target(spark: SparkSession, root: str) -> DataFrame:
    rows = events(spark, root)
    return rows.where(F.col("ts") > loads(spark, root).where("load = 0").agg(F.max("ts")).scalar())


@query(f"""
    SELECT event_id, ts, user_id FROM events
    WHERE ts > (SELECT coalesce(max(ts), TIMESTAMP '1900-01-01') FROM events WHERE {LOAD_SQL} <= 1)
""", name="incremental_slice")
def incremental_rows(spark: SparkSession, root: str) -> DataFrame:
    done = loads(spark, root).where("load <= 1")
    return incremental_slice(events(spark, root), done, "ts").select("event_id", "ts", "user_id")


@query("SELECT event_id, ts, user_id FROM events")
def incremental_slice_first_run(spark: SparkSession, root: str) -> DataFrame:
    """Nothing is in the target yet, so every row is above the mark."""
    nothing = loads(spark, root).where("load < 0")
    return incremental_slice(events(spark, root), nothing, "ts").select("event_id", "ts", "user_id")


@query("""
    SELECT o_orderkey,
           CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE 'other' END AS state,
           coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), 'none') AS priority
    FROM orders
""")
def case_coalesce(spark: SparkSession, root: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return read_table(spark, root, "orders").select(
        "o_orderkey",
        F.when(status == "F", "done").when(status == "O", "open").otherwise("other").alias("state"),
        F.coalesce(F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")), F.lit("none")).alias("priority"),
    )


@query("""
    SELECT DISTINCT concat('/store/', p_brand, '/', p_type, '/') AS location, concat_ws('.', p_brand, p_type) AS name
    FROM part
""")
def concat_path(spark: SparkSession, root: str) -> DataFrame:
    brand, kind = F.col("p_brand"), F.col("p_type")
    return read_table(spark, root, "part").select(
        F.concat(F.lit("/store/"), brand, F.lit("/"), kind, F.lit("/")).alias("location"),
        F.concat_ws(".", brand, kind).alias("name"),
    ).distinct()


@query(f"""
    WITH active AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS place
                       FROM events WHERE {LOAD_SQL} = 0) WHERE place = 1
    )
    SELECT b.event_id, b.user_id, b.ts AS new_ts, a.ts AS old_ts, a.event_type AS old_type
    FROM (SELECT * FROM events WHERE {LOAD_SQL} >= 1) b JOIN active a ON a.user_id = b.user_id AND a.ts <> b.ts
""")
def join_equi_theta(spark: SparkSession, root: str) -> DataFrame:
    """Batch rows against the one active row of their key, if its time differs."""
    rows = loads(spark, root)
    batch = rows.where("load >= 1").alias("b")
    active = scd1_build(rows.where("load = 0"), ["user_id"], "ts").alias("a")
    matched = batch.join(active, (F.col("a.user_id") == F.col("b.user_id")) & (F.col("a.ts") != F.col("b.ts")))
    return matched.select(
        "b.event_id",
        "b.user_id",
        F.col("b.ts").alias("new_ts"),
        F.col("a.ts").alias("old_ts"),
        F.col("a.event_type").alias("old_type"),
    )


@query("""
    SELECT c_custkey, c_name, n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def customers_country_lookup(spark: SparkSession, root: str) -> DataFrame:
    customers = read_table(spark, root, "customer")
    joined = lookup_join(customers, read_table(spark, root, "nation"), "c_nationkey", "n_nationkey")
    return joined.select("c_custkey", "c_name", F.col("n_name").alias("country"))


def _order_rows(spark: SparkSession, root: str) -> DataFrame:
    """Orders whose lines are an array of structs, as order messages carry them."""
    lines = read_table(spark, root, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_linenumber").alias("number"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("subtotal"),
    )
    nested = nest_lines(lines, ["o_orderkey"], ["partkey", "quantity", "subtotal"], "number", "lines")
    return read_table(spark, root, "orders").join(nested, "o_orderkey")


@query("""
    SELECT o_orderkey, o_custkey, l_linenumber AS line_number, l_partkey AS line_partkey,
           l_quantity AS line_quantity, l_extendedprice AS line_subtotal, p_brand
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
""")
def order_lines_join(spark: SparkSession, root: str) -> DataFrame:
    parts = read_table(spark, root, "part").select("p_partkey", "p_brand")
    lines = order_lines(_order_rows(spark, root), parts, "lines", "partkey", "p_partkey")
    return lines.select(
        "o_orderkey", "o_custkey", "line_number", "line_partkey", "line_quantity", "line_subtotal", "p_brand"
    )


@query("""
    SELECT l_orderkey AS o_orderkey, l_linenumber AS number, l_partkey AS partkey, l_quantity AS quantity
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
""")
def nest_order_lines(spark: SparkSession, root: str) -> DataFrame:
    flat = _order_rows(spark, root).select("o_orderkey", F.inline("lines"))
    return flat.select("o_orderkey", "number", "partkey", "quantity")


@query("""
    SELECT time_bucket(INTERVAL 5 MINUTE, o_orderdate, TIMESTAMP '1970-01-01') AS window_start,
           time_bucket(INTERVAL 5 MINUTE, o_orderdate, TIMESTAMP '1970-01-01') + INTERVAL 5 MINUTE AS window_end,
           p_brand AS author, count(*) AS orders_count, round(avg(l_quantity), 6) AS avg_quantity
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
    GROUP BY ALL
""")
def gold_author_stats(spark: SparkSession, root: str) -> DataFrame:
    parts = read_table(spark, root, "part").select("p_partkey", F.col("p_brand").alias("author"))
    lines = read_table(spark, root, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = read_table(spark, root, "orders").select("o_orderkey", "o_orderdate")
    sold = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    stats = author_stats(sold, "o_orderdate", "o_orderkey", "l_quantity")
    return stats.withColumn("avg_quantity", F.round("avg_quantity", 6))


@query("SELECT event_type, count(*) AS n_rows FROM events GROUP BY event_type")
def count_by_source(spark: SparkSession, root: str) -> DataFrame:
    return count_rows(events(spark, root), "event_type")


@query("SELECT count(*) AS n_rows FROM lineitem")
def count_all(spark: SparkSession, root: str) -> DataFrame:
    return count_rows(read_table(spark, root, "lineitem"))


@query("SELECT event_type, count(DISTINCT user_id) AS n_keys FROM events GROUP BY event_type")
def distinct_keys(spark: SparkSession, root: str) -> DataFrame:
    return count_keys(events(spark, root), ["user_id"], "event_type")


@query("SELECT event_type, true AS within, count(DISTINCT user_id) AS exact FROM events GROUP BY event_type")
def distinct_keys_sketched(spark: SparkSession, root: str) -> DataFrame:
    """Sketches of the keys of each load, stored and added up; within five standard errors of the exact number."""
    area, rows = new_area(spark, "sketches"), loads(spark, root)
    key_sketches(rows, ["user_id"], "load", "event_type").write.parquet(area)
    estimated = keys_of_sketches(spark.read.parquet(area), "event_type").withColumnRenamed("n_keys", "estimate")
    both = count_keys(rows, ["user_id"], "event_type").join(estimated, "event_type")
    error = F.abs(F.col("estimate") - F.col("n_keys"))
    return both.select("event_type", (error <= 5 * 1.04 / 2 ** (SKETCH_BITS / 2) * F.col("n_keys") + 1).alias("within"),
                       F.col("n_keys").alias("exact"))


@query("SELECT DISTINCT user_id, event_type, date_trunc('day', ts)::TIMESTAMP AS day FROM events")
def distinct_select(spark: SparkSession, root: str) -> DataFrame:
    day = F.date_trunc("day", "ts").alias("day")
    return events(spark, root).select("user_id", "event_type", day).distinct()


@query("""
    SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, min(value) AS low, max(value) AS high
    FROM events GROUP BY user_id
""")
def min_max_per_key(spark: SparkSession, root: str) -> DataFrame:
    return events(spark, root).groupBy("user_id").agg(
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )


@query("""
    SELECT time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') AS window_start,
           time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '1970-01-01') + INTERVAL 5 MINUTE AS window_end,
           event_type, count(*) AS n_rows, round(avg(value), 6) AS avg_value
    FROM events GROUP BY ALL
""", name="tumbling_stats")
def tumbling_windows(spark: SparkSession, root: str) -> DataFrame:
    stats = tumbling_stats(zoned(events(spark, root), "ts"), "ts", "5 minutes", ["event_type"], "event_id", "value")
    return stats.withColumn("avg_value", F.round("avg_value", 6))


@query("""
    SELECT user_id, '(' || string_agg(DISTINCT event_type || ' STRING', ',' ORDER BY event_type || ' STRING') || ')'
           AS fields
    FROM events GROUP BY user_id
""", name="string_agg")
def string_lists(spark: SparkSession, root: str) -> DataFrame:
    """The distinct event types of a user written as a column list."""
    item = F.concat_ws(" ", "event_type", F.lit("STRING"))
    listed = string_agg(events(spark, root), ["user_id"], item, "fields")
    return listed.withColumn("fields", F.concat(F.lit("("), "fields", F.lit(")")))


@query("""
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice
    FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS place FROM orders)
    WHERE place = 1
""")
def rank_latest(spark: SparkSession, root: str) -> DataFrame:
    """Latest orders per customer; customers with several orders on their last day keep all of them."""
    latest = latest_per_key(read_table(spark, root, "orders"), ["o_custkey"], "o_orderdate")
    return latest.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


LEAD_SQL = """
    SELECT o_orderkey, o_custkey, o_orderdate, coalesce(lead(o_orderdate) OVER (PARTITION BY o_custkey
           ORDER BY o_orderdate, o_orderkey), TIMESTAMP '9999-12-31 23:59:59') AS next_date
    FROM orders
"""


def _leads(spark: SparkSession, root: str, **limit: int) -> DataFrame:
    orders = read_table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    rows = next_sequence(orders, ["o_custkey"], "o_orderdate", "next_date", **limit)
    return rows.withColumn("next_date", F.coalesce("next_date", F.lit("9999-12-31 23:59:59").cast("timestamp_ntz")))


@query(LEAD_SQL)
def lead_interval(spark: SparkSession, root: str) -> DataFrame:
    """Day of the customer's next order; several orders on one day all stay."""
    return _leads(spark, root)


@query(LEAD_SQL)
def lead_interval_split(spark: SparkSession, root: str) -> DataFrame:
    """The same rows with a low limit for rows per task."""
    return _leads(spark, root, hot_rows=12)


@query("SELECT user_id, ts, event_id, event_type FROM events ORDER BY user_id ASC, ts DESC, event_id")
def sort_mixed(spark: SparkSession, root: str) -> DataFrame:
    ordered = events(spark, root).orderBy(["user_id", "ts", "event_id"], ascending=[True, False, True])
    return ordered.select("user_id", "ts", "event_id", "event_type")


@query("""
    SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders
    ORDER BY list_position(['P', 'O', 'F'], o_orderstatus), o_orderdate, o_orderkey
""")
def sort_custom_order(spark: SparkSession, root: str) -> DataFrame:
    ordered = read_table(spark, root, "orders").orderBy(
        in_given_order("o_orderstatus", ["P", "O", "F"]), "o_orderdate", "o_orderkey"
    )
    return ordered.select("o_orderkey", "o_orderstatus", "o_orderdate")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def top_n(spark: SparkSession, root: str) -> DataFrame:
    ordered = read_table(spark, root, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return ordered.limit(100).select("o_orderkey", "o_totalprice")


@query(f"""
    SELECT 'A' AS feed, event_id, user_id FROM events WHERE ts < TIMESTAMP '{FEED_A_END}'
    UNION ALL SELECT 'B', event_id, user_id FROM events WHERE ts >= TIMESTAMP '{FEED_B_START}'
""")
def union_all(spark: SparkSession, root: str) -> DataFrame:
    a, b = (df.select(F.lit(n).alias("feed"), "event_id", "user_id") for n, df in zip("AB", _feeds(spark, root)))
    return a.union(b)


@query("""
    SELECT 'brand' AS kind, p_brand AS name FROM part
    UNION SELECT 'type', concat(p_brand, '.', p_type) FROM part
""")
def union_distinct(spark: SparkSession, root: str) -> DataFrame:
    parts = read_table(spark, root, "part")
    brands = parts.select(F.lit("brand").alias("kind"), F.col("p_brand").alias("name"))
    types = parts.select(F.lit("type"), F.concat_ws(".", "p_brand", "p_type"))
    return brands.union(types).distinct()


@query("""
    SELECT p_name AS label, p_retailprice AS amount, CAST(NULL AS VARCHAR) AS note FROM part
    UNION ALL SELECT p_name, CAST(p_size AS DOUBLE), 'size' FROM part
""")
def union_by_name(spark: SparkSession, root: str) -> DataFrame:
    """Other column order, a whole number widened to double and a column only one side has."""
    parts = read_table(spark, root, "part")
    prices = parts.select(F.col("p_name").alias("label"), F.col("p_retailprice").alias("amount"))
    sizes = parts.select(
        F.lit("size").alias("note"), F.col("p_size").cast("double").alias("amount"), F.col("p_name").alias("label")
    )
    return union_widened(prices, sizes)
