"""Sources, sinks and payload handling over the message feed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.scalars import ingest_stamp as stamp
from tierflow.functions.scalars import ingest_stamp_text as stamp_text
from tierflow.functions.scalars import from_millis, parse_ts, show_ts, text, to_millis, wall_clock
from tierflow.operators.shape import conform, union_widened
from tierflow.plans.catalog import query
from tierflow.plans.inputs import (
    EVENT_TOPICS,
    LOAD_SQL,
    envelopes,
    events,
    landed_feed,
    loads,
)
from tierflow.session import new_area
from tierflow.sources.feed import (
    file_label,
    land_feed,
    parse_all,
    parse_topic,
    raw_feed,
    rejected_rows,
    rescued_fields,
    scan_envelopes,
    slice_by_file,
    sort_out,
)
from tierflow.sources.registry import registry
from tierflow.sources.tables import read_batches, read_table
from tierflow.streaming.admission import Landing, SchemaLog, run_growing
from tierflow.streaming.sinks import append_batches, run_stream, write_batch

# Files of a landed load.
FILES = 4

ENVELOPE_SQL = """
    SELECT event_type AS topic, CAST(user_id AS VARCHAR) AS key, user_id % 8 AS feed_partition,
           event_id AS feed_offset, epoch_us(ts) // 1000 AS feed_millis
    FROM events
"""


def _envelope_columns(feed: DataFrame) -> DataFrame:
    return feed.select(
        "topic",
        text(F.col("key")).alias("key"),
        F.col("partition").alias("feed_partition"),
        F.col("offset").alias("feed_offset"),
        F.col("timestamp").alias("feed_millis"),
    )


@query(ENVELOPE_SQL)
def feed_scan_batch(spark: SparkSession, root: str) -> DataFrame:
    return _envelope_columns(scan_envelopes(spark, landed_feed(spark, root, "scan-batch")))


@query(ENVELOPE_SQL)
def feed_scan_stream(spark: SparkSession, root: str) -> DataFrame:
    landing = landed_feed(spark, root, "scan-stream")
    area = new_area(spark, "scan-stream")
    run_stream(_envelope_columns(scan_envelopes(spark, landing, streaming=True)), f"{area}/table", f"{area}/marks")
    return spark.read.parquet(f"{area}/table")


@query(f"SELECT CAST({LOAD_SQL} AS BIGINT) AS batch_id, event_type AS topic, event_id FROM events")
def feed_incremental_files(spark: SparkSession, root: str) -> DataFrame:
    """Three runs over a growing folder; each takes in only the files that came since the last."""
    area = new_area(spark, "incremental")
    rows = loads(spark, root)
    for number in range(3):
        land_feed(envelopes(rows.where(F.col("load") == number)), f"{area}/landing")
        feed = scan_envelopes(spark, f"{area}/landing", streaming=True)
        append_batches(feed.select("topic", F.col("offset").alias("event_id")), f"{area}/table", f"{area}/marks")
    table = read_batches(spark, f"{area}/table")
    return table.select(F.col("batch_id").cast("bigint").alias("batch_id"), "topic", "event_id")


@query(f"SELECT CAST({LOAD_SQL} AS BIGINT) AS batch_id, event_type AS topic, event_id FROM events")
def feed_file_replay(spark: SparkSession, root: str) -> DataFrame:
    """Loads of several files that all wait already, taken in one per micro-batch in the order in which they came."""
    area = new_area(spark, "replay")
    landing, rows = Landing(f"{area}/landing", "json"), loads(spark, root)
    for number in range(3):
        landing.land(envelopes(rows.where(F.col("load") == number)).repartition(FILES), number)

    def take(feed: DataFrame, number: int) -> None:
        write_batch(feed.select("topic", F.col("offset").alias("event_id")), f"{area}/table", number)

    landing.admit(spark, scan_envelopes, take, f"{area}/marks")
    table = read_batches(spark, f"{area}/table")
    return table.select(F.col("batch_id").cast("bigint").alias("batch_id"), "topic", "event_id")


@query("""
    SELECT event_type AS topic, CAST(user_id AS VARCHAR) AS key, event_id,
           date_trunc('milliseconds', ts) AS create_ts
    FROM events
""")
def feed_normalise(spark: SparkSession, root: str) -> DataFrame:
    feed = raw_feed(spark, landed_feed(spark, root, "normalise"))
    event_id = F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id")
    return feed.select("topic", "key", event_id, "create_ts")


@query("""
    SELECT 'events.parquet' AS source_file, count(*) AS n_rows FROM events
    UNION ALL SELECT 'orders.parquet', count(*) FROM orders
    UNION ALL SELECT 'customer.parquet', count(*) FROM customer
""")
def source_file_lineage(spark: SparkSession, root: str) -> DataFrame:
    labelled = [
        read_table(spark, root, name).select(file_label(F.col("_metadata.file_path")).alias("source_file"))
        for name in ("events", "orders", "customer")
    ]
    return union_widened(*labelled).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"""
    SELECT 'feed_02.json' AS source_file, event_id, ts, user_id, value
    FROM events WHERE {LOAD_SQL} = 1 AND event_type = 'purchase'
""")
def single_file_slice(spark: SparkSession, root: str) -> DataFrame:
    area = new_area(spark, "slice")
    rows = loads(spark, root)
    for number in range(3):
        land_feed(envelopes(rows.where(F.col("load") == number)), f"{area}/feed_0{number + 1}.json")
    feed = slice_by_file(raw_feed(spark, f"{area}/feed_*.json"), "feed_02.json")
    slice_ = parse_topic(feed, EVENT_TOPICS["purchase"])
    return slice_.select(file_label(F.col("source_file")).alias("source_file"), "event_id", "ts", "user_id", "value")


@query("""SELECT event_id, CAST(regexp_extract(props, ':\\s*(\\d+)', 1) AS INTEGER) AS k FROM events""")
def topic_parse(spark: SparkSession, root: str) -> DataFrame:
    parsed = events(spark, root).select("event_id", F.from_json("props", "k INT").alias("v"))
    return parsed.select("event_id", "v.*")


def _payload(*fields: str, topics: Iterable[str] = EVENT_TOPICS) -> list[Column]:
    """Fields of whichever topic a row belongs to."""
    return [F.coalesce(*[F.col(f"{t}.{f}") for t in topics]).alias(f) for f in fields]


@query("SELECT event_type AS topic, event_id, user_id, value FROM events")
def all_topics(spark: SparkSession, root: str) -> DataFrame:
    feed = parse_all(raw_feed(spark, landed_feed(spark, root, "all-topics")), EVENT_TOPICS)
    return feed.select("topic", *_payload("event_id", "user_id", "value"))


KNOWN_TOPICS = {t: EVENT_TOPICS[t] for t in ("click", "purchase", "view")}


def _troubled_feed(spark: SparkSession, root: str, label: str) -> DataFrame:
    """One topic missing, one unknown, and values of one topic that are no JSON."""
    topic = F.when(F.col("event_type") != "error", F.col("event_type"))
    value = F.when((F.col("event_type") == "view") & (F.col("value") > 100), F.concat(F.lit("broken "), "event_id"))
    landing = land_feed(envelopes(events(spark, root), topic, value), new_area(spark, label) + "/landing")
    return raw_feed(spark, landing)


@query("""
    SELECT event_type AS topic, event_id, user_id, value FROM events
    WHERE event_type IN ('click', 'purchase') OR (event_type = 'view' AND value <= 100)
""")
def route_known(spark: SparkSession, root: str) -> DataFrame:
    """The good rows of all topics in one pass."""
    rows = sort_out(_troubled_feed(spark, root, "route"), KNOWN_TOPICS).where(F.col("reason").isNull())
    return rows.select("topic", *_payload("event_id", "user_id", "value", topics=KNOWN_TOPICS))


@query("""
    SELECT CASE WHEN event_type <> 'error' THEN event_type END AS topic, CAST(user_id AS VARCHAR) AS key,
           date_trunc('milliseconds', ts) AS create_ts,
           CASE event_type WHEN 'error' THEN 'no topic' WHEN 'signup' THEN 'unknown topic'
                ELSE 'unreadable value' END AS reason
    FROM events
    WHERE event_type IN ('error', 'signup') OR (event_type = 'view' AND value > 100)
""")
def quarantine(spark: SparkSession, root: str) -> DataFrame:
    rejected = rejected_rows(sort_out(_troubled_feed(spark, root, "quarantine"), KNOWN_TOPICS))
    return rejected.select("topic", "key", "create_ts", "reason")


def _damaged_feed(spark: SparkSession, root: str, label: str) -> DataFrame:
    """Values whose fields have the wrong type or are left out: required ones of three topics, an optional one of another."""
    kind, parity = F.col("event_type"), F.col("event_id") % 2
    rows = events(spark, root).withColumns({
        "a": F.when((kind == "click") & (parity == 0), "none").otherwise(F.col("event_id").cast("string")),
        "b": F.when((kind == "purchase") & (parity == 0), "soon").when((kind == "purchase") | (kind == "signup"), None)
        .otherwise(F.col("ts").cast("string")),
        "c": F.when((kind == "view") & (parity == 0), "much").otherwise(F.col("value").cast("string")),
    })
    # Numbers are written as numbers, words as strings; NULL fields are left out.
    quoted = {n: F.when(F.col(n).rlike("^[a-z]"), F.concat(F.lit('"'), n, F.lit('"'))).otherwise(F.col(n)) for n in "abc"}
    fields = [("event_id", quoted["a"]), ("ts", F.concat(F.lit('"'), "b", F.lit('"'))), ("user_id", F.col("user_id").cast("string")),
              ("value", quoted["c"])]
    parts = F.concat_ws(",", *[F.concat(F.lit(f'"{n}":'), v) for n, v in fields])
    landing = land_feed(envelopes(rows, value=F.concat(F.lit("{"), parts, F.lit("}"))), new_area(spark, label) + "/landing")
    return raw_feed(spark, landing)


#: The same topics as a configuration file would have them.
CONFIGURED = registry(
    {"name": t.name, "schema": t.schema, "keys": list(t.keys), "sequence_by": t.sequence_by, "required": list(t.required)}
    for t in EVENT_TOPICS.values()
)


@query("""
    SELECT event_type AS topic, CAST(user_id AS VARCHAR) AS key, date_trunc('milliseconds', ts) AS create_ts,
           CASE WHEN event_type = 'click' THEN 'unreadable field: event_id'
                WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN 'unreadable field: ts' ELSE 'missing field: ts' END AS reason
    FROM events WHERE event_type IN ('purchase', 'signup') OR (event_type = 'click' AND event_id % 2 = 0)
""")
def quarantine_required(spark: SparkSession, root: str) -> DataFrame:
    """Messages without a readable value for a field that their topic requires."""
    rejected = rejected_rows(sort_out(_damaged_feed(spark, root, "required"), CONFIGURED))
    return rejected.select("topic", "key", "create_ts", "reason")


@query("""
    SELECT event_type AS topic, CAST(user_id AS VARCHAR) AS key,
           CASE event_type WHEN 'click' THEN 'event_id' WHEN 'purchase' THEN 'ts' ELSE 'value' END AS field,
           CASE event_type WHEN 'click' THEN 'none' WHEN 'purchase' THEN 'soon' ELSE 'much' END AS raw, event_type = 'view' AS good
    FROM events WHERE event_type IN ('click', 'purchase', 'view') AND event_id % 2 = 0
""")
def rescued_values(spark: SparkSession, root: str) -> DataFrame:
    """Raw values of fields that could not be read, of rows that stay without them and of rows in the quarantine."""
    found = rescued_fields(sort_out(_damaged_feed(spark, root, "rescued"), CONFIGURED))
    return found.select("topic", "key", "field", "raw", F.col("reason").isNull().alias("good"))


@query(f"""
    SELECT event_id, ts, CASE WHEN {LOAD_SQL} = 0 THEN NULL ELSE props END AS props, CAST({LOAD_SQL} AS BIGINT) AS load
    FROM events
""")
def schema_evolution_union(spark: SparkSession, root: str) -> DataFrame:
    """The first load lacks a column that later loads have; the table reads as one."""
    area = new_area(spark, "evolution")
    rows = loads(spark, root).select("event_id", "ts", "props", "load")
    write_batch(rows.where("load = 0").drop("props"), area, 0)
    write_batch(rows.where("load > 0"), area, 1)
    table = spark.read.option("mergeSchema", True).option("basePath", area).parquet(f"{area}/query=*")
    return table.select("event_id", "ts", "props", "load")


@query(f"""
    SELECT event_id, CASE WHEN {LOAD_SQL} = 0 THEN CAST(user_id AS DOUBLE) ELSE value END AS score,
           CASE WHEN {LOAD_SQL} > 0 THEN user_id END AS user_id, CASE WHEN {LOAD_SQL} = 2 THEN props END AS props
    FROM events
""")
def schema_evolution_stream(spark: SparkSession, root: str) -> DataFrame:
    """Three runs on one checkpoint; later loads bring new columns, and an integer column becomes a fractional one."""
    area = new_area(spark, "growing")
    landing, schemas = Landing(f"{area}/landing"), SchemaLog(f"{area}/schemas")
    whole = F.col("user_id").cast("int")
    columns = [["event_id", whole.alias("score")], ["event_id", F.col("value").alias("score"), whole.alias("user_id")],
               ["event_id", F.col("value").alias("score"), "user_id", "props"]]
    for number, load in enumerate(columns):
        landing.land(loads(spark, root).where(F.col("load") == number).select(*load), number)
        run_growing(spark, landing, schemas, lambda rows: run_stream(rows, f"{area}/table", f"{area}/marks"))
    return schemas.read(spark, f"{area}/table")


@query(f"SELECT CAST({LOAD_SQL} AS BIGINT) AS batch_id, event_id, value FROM events")
def append_idempotent(spark: SparkSession, root: str) -> DataFrame:
    """Every load is appended, one of them twice."""
    area = new_area(spark, "append")
    rows = loads(spark, root)
    for number in (0, 1, 2, 1):
        write_batch(rows.where(F.col("load") == number).select("event_id", "value"), area, number)
    return read_batches(spark, area).select(F.col("batch_id").cast("bigint").alias("batch_id"), "event_id", "value")


@query("SELECT event_id, user_id, value, event_type FROM events")
def json_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    fields = "event_id BIGINT, user_id BIGINT, value DOUBLE, event_type STRING"
    document = F.to_json(F.struct("event_id", "user_id", "value", "event_type"))
    return events(spark, root).select(F.from_json(document, fields).alias("v")).select("v.*")


@query("SELECT event_id, epoch_us(ts) // 1000 AS millis, date_trunc('milliseconds', ts) AS at_ts FROM events")
def epoch_millis(spark: SparkSession, root: str) -> DataFrame:
    return events(spark, root).select("event_id", to_millis(F.col("ts")).alias("millis")).withColumn(
        "at_ts", from_millis(F.col("millis"))
    )


@query("SELECT event_id, ts + INTERVAL 330 MINUTE AS local_ts FROM events")
def tz_shift(spark: SparkSession, root: str) -> DataFrame:
    return events(spark, root).select("event_id", wall_clock(F.col("ts"), "Asia/Kolkata").alias("local_ts"))


@query("""
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown, date_trunc('second', ts) AS parsed FROM events
""")
def ts_format(spark: SparkSession, root: str) -> DataFrame:
    pattern = "yyyy-MM-dd HH:mm:ss"
    shown = events(spark, root).select("event_id", show_ts(F.col("ts"), pattern).alias("shown"))
    return shown.withColumn("parsed", parse_ts(F.col("shown"), pattern))


@query("SELECT event_id, true AS same_for_all, true AS text_agrees, true AS ahead_of_utc FROM events")
def ingest_stamp(spark: SparkSession, root: str) -> DataFrame:
    """All rows of one run carry one insertion time, as a timestamp and as text, on the clock of the given zone."""
    stamped = events(spark, root).select(
        "event_id", stamp("Asia/Kolkata").alias("at"), stamp_text("Asia/Kolkata").alias("shown"), stamp().alias("utc")
    )
    first = stamped.agg(F.min("at")).scalar()
    return stamped.select(
        "event_id",
        (F.col("at") == first).alias("same_for_all"),
        (F.date_format("at", "yyyy-MM-dd HH:mm:ss") == F.col("shown")).alias("text_agrees"),
        (F.col("at") == F.col("utc") + F.expr("INTERVAL 330 MINUTES")).alias("ahead_of_utc"),
    )


DECLARED = "event_id BIGINT NOT NULL, amount DOUBLE NOT NULL, kind STRING, at_ts TIMESTAMP"


def _loose_rows(spark: SparkSession, root: str) -> DataFrame:
    amount = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    return events(spark, root).select(
        F.col("event_id").cast("string").alias("event_id"),
        amount.alias("amount"),
        F.col("event_type").alias("kind"),
        F.col("ts").cast("string").alias("at_ts"),
    )


@query("SELECT event_id, value AS amount, event_type AS kind, ts AS at_ts FROM events WHERE event_type <> 'error'")
def conform_schema(spark: SparkSession, root: str) -> DataFrame:
    good, _ = conform(_loose_rows(spark, root), DECLARED)
    return good


@query("""
    SELECT CAST(event_id AS VARCHAR) AS event_id, 'n/a' AS amount, event_type AS kind, 'amount' AS missing
    FROM events WHERE event_type = 'error'
""")
def conform_rejects(spark: SparkSession, root: str) -> DataFrame:
    """Rejected rows keep the values that could not be used."""
    _, rejected = conform(_loose_rows(spark, root), DECLARED)
    return rejected.drop("at_ts")


INLINE_PARTS = [(0, "blue bolt", 59), (1, "red widget", 69), (900_000_001, "new part", 11)]


@query("""
    SELECT p_partkey, p_name, p_retailprice FROM part
    UNION ALL
    SELECT * FROM (VALUES (CAST(0 AS BIGINT), 'blue bolt', 59.0::DOUBLE), (1, 'red widget', 69.0::DOUBLE),
                          (900000001, 'new part', 11.0::DOUBLE))
""")
def inline_updates(spark: SparkSession, root: str) -> DataFrame:
    """A table followed by typed inline rows whose whole-number prices widen to the table's type."""
    parts = read_table(spark, root, "part").select("p_partkey", "p_name", "p_retailprice")
    rows = spark.createDataFrame(INLINE_PARTS, "p_partkey bigint, p_name string, p_retailprice int")
    return parts.unionByName(rows.withColumn("p_retailprice", F.col("p_retailprice").cast("double")))


@query("SELECT event_type AS topic, event_id, ts, user_id, value, props FROM events")
def topic_payloads(spark: SparkSession, root: str) -> DataFrame:
    """Every topic parsed in one pass over the feed."""
    feed = parse_all(raw_feed(spark, landed_feed(spark, root, "payloads")), EVENT_TOPICS)
    return feed.select("topic", *_payload("event_id", "ts", "user_id", "value", "props"))
