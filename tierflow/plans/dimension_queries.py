"""Merges, slowly changing dimensions, change feeds and marks over the events as a change log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators import changes as cdc
from tierflow.operators import merge, scd
from tierflow.operators.reduce import latest_per_key as latest
from tierflow.plans.catalog import query
from tierflow.plans.inputs import LATE_LOAD_SQL, LATE_TYPE, LOAD_SQL, TOPICS, events, load_numbers, loads
from tierflow.session import new_area
from tierflow.sources.tables import read_batches, read_table
from tierflow.streaming.key_filter import KeyFilter, new_rows, slots_for
from tierflow.streaming.sinks import write_audited, write_batch
from tierflow.streaming.snapshots import Snapshots

USER = ["user_id"]
PAIR = ["user_id", "event_type"]
OPS = ("signup", "purchase")
FIELDS = ("user_id", "event_type", "event_id", "ts", "value")


def latest_sql(keys: str, where: str = "true", columns: str = "user_id, event_type, event_id, ts, value") -> str:
    return f"""
        SELECT {columns} FROM (
            SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ts DESC) AS place FROM events WHERE {where}
        ) WHERE place = 1
    """


def scd2_sql(columns: str = "user_id, event_type, event_id, value", where: str = "true") -> str:
    return f"""
        SELECT {columns}, ts AS start_date, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS end_date,
               lead(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL AS is_active
        FROM events WHERE {where}
    """


def _log(spark: SparkSession, root: str) -> DataFrame:
    return events(spark, root).select(*FIELDS)


def _loads(spark: SparkSession, root: str, schedule: str = LOAD_SQL) -> DataFrame:
    return loads(spark, root, schedule).select(*FIELDS, "load")


def _part(log: DataFrame, *numbers: int) -> DataFrame:
    return log.where(F.col("load").isin(*numbers)).drop("load")


@query(latest_sql("user_id", f"event_type IN {OPS}"))
def latest_per_key(spark: SparkSession, root: str) -> DataFrame:
    return latest(_log(spark, root), USER, "ts", where=F.col("event_type").isin(*OPS))


@query(latest_sql("user_id"))
def scd1_build(spark: SparkSession, root: str) -> DataFrame:
    return scd.scd1_build(_log(spark, root), USER, "ts")


@query(latest_sql("user_id", f"event_type IN {OPS}"))
def scd1_apply_batch(spark: SparkSession, root: str) -> DataFrame:
    """Two overlapping batches, the later one applied first."""
    log = _loads(spark, root)
    first = scd.scd1_build(_part(log, 1, 2), USER, "ts", OPS, "event_type")
    return scd.scd1_apply(first, _part(log, 0, 1), USER, "ts", OPS, "event_type")


@query(scd2_sql())
def scd2_build(spark: SparkSession, root: str) -> DataFrame:
    return scd.scd2_build(_log(spark, root), USER, "ts")


@query(scd2_sql())
def scd2_build_split(spark: SparkSession, root: str) -> DataFrame:
    """The same table with a low limit for rows per task, so that the busiest users are cut into ranges."""
    return scd.scd2_build(_log(spark, root), USER, "ts", hot_rows=60)


@query(f"""
    SELECT user_id, event_type, event_id, value, start_date,
           coalesce(end_date, TIMESTAMP '9999-12-31 23:59:59') AS end_date,
           CASE WHEN is_active THEN 'Y' ELSE 'N' END AS is_active
    FROM ({scd2_sql()})
""")
def scd2_open_end(spark: SparkSession, root: str) -> DataFrame:
    """Far-future end date and text flag on the open versions."""
    end = F.lit("9999-12-31 23:59:59").cast("timestamp_ntz")
    return scd.flag_text(scd.scd2_build(_log(spark, root), USER, "ts", open_end=end))


@query(scd2_sql())
def scd2_apply_batch(spark: SparkSession, root: str) -> DataFrame:
    """The middle load comes last and the final one is delivered twice."""
    log = _loads(spark, root)
    stored = new_area(spark, "scd2-apply")
    scd.scd2_build(_part(log, 0, 2), USER, "ts").write.parquet(stored)
    return scd.scd2_apply(spark.read.parquet(stored), _part(log, 1, 2), USER, "ts")


@query(f"SELECT * FROM ({scd2_sql()}) WHERE is_active")
def current_rows(spark: SparkSession, root: str) -> DataFrame:
    return scd.current_rows(scd.scd2_build(_log(spark, root), USER, "ts"))


AS_OF = "2024-01-15 12:00:00"


@query(f"""
    SELECT * FROM ({scd2_sql()})
    WHERE start_date <= TIMESTAMP '{AS_OF}' AND (end_date IS NULL OR TIMESTAMP '{AS_OF}' < end_date)
""")
def scd2_as_of(spark: SparkSession, root: str) -> DataFrame:
    return scd.as_of(scd.scd2_build(_log(spark, root), USER, "ts"), F.lit(AS_OF).cast("timestamp_ntz"))


@query(latest_sql("user_id", f"{LATE_LOAD_SQL} <= 1"))
def state_as_of_version(spark: SparkSession, root: str) -> DataFrame:
    log = cdc.up_to_version(_loads(spark, root, LATE_LOAD_SQL), "load", 1)
    return scd.scd1_build(log.drop("load"), USER, "ts")


@query(f"""
    SELECT CAST({LATE_LOAD_SQL} AS BIGINT) AS load, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts
    FROM events GROUP BY 1
""")
def load_history(spark: SparkSession, root: str) -> DataFrame:
    return cdc.load_history(_loads(spark, root, LATE_LOAD_SQL), "load", "ts")


@query(f"""
    SELECT CAST({LATE_LOAD_SQL} AS BIGINT) AS load, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts
    FROM events GROUP BY 1
""")
def load_audit(spark: SparkSession, root: str) -> DataFrame:
    """The same history from what was noted while the loads were written, one of them twice; no load is read."""
    area, log = new_area(spark, "audit"), _loads(spark, root, LATE_LOAD_SQL)
    numbers = load_numbers(log)
    for number in [*numbers, *numbers[:1]]:
        write_audited(log.where(F.col("load") == number), f"{area}/log", number, "ts", f"{area}/audit")
    if not numbers:
        return cdc.load_history(log, "load", "ts")
    audit = read_batches(spark, f"{area}/audit")
    return audit.select(F.col("batch_id").cast("bigint").alias("load"), "n_rows", "first_ts", "last_ts")


@query(f"SELECT user_id, event_type, event_id, ts, value FROM events WHERE {LATE_LOAD_SQL} = 2")
def latest_batch_only(spark: SparkSession, root: str) -> DataFrame:
    return cdc.latest_load(_loads(spark, root, LATE_LOAD_SQL), "load").drop("load")


# Three states of a table keyed by (user, type): rows up to a day, the last one with all rows.
DAYS = ("2024-01-03", "2024-01-10", None)
T0, T1, T2 = (f"2024-02-0{n} 06:00:00" for n in (1, 2, 3))


def _state_sql(day: str | None, drop_type: bool = False) -> str:
    return latest_sql(
        "user_id, event_type",
        (f"ts < TIMESTAMP '{day}'" if day else "true") + (f" AND event_type <> '{LATE_TYPE}'" if drop_type else ""),
    )


def _state(spark: SparkSession, root: str, day: str | None, drop_type: bool = False) -> DataFrame:
    rows = _log(spark, root)
    if day:
        rows = rows.where(F.col("ts") < F.lit(day).cast("timestamp_ntz"))
    if drop_type:
        rows = rows.where(F.col("event_type") != LATE_TYPE)
    return scd.scd1_build(rows, PAIR, "ts")


def _at(moment: str):
    return F.lit(moment).cast("timestamp_ntz")


@query(f"""
    WITH a AS ({_state_sql(DAYS[0])}), b AS ({_state_sql(DAYS[2], True)}), tagged AS (
        SELECT b.*, 'insert' AS _change_type FROM b LEFT JOIN a USING (user_id, event_type) WHERE a.event_id IS NULL
        UNION ALL
        SELECT a.*, 'delete' FROM a LEFT JOIN b USING (user_id, event_type) WHERE b.event_id IS NULL
        UNION ALL
        SELECT a.*, 'update_preimage' FROM a JOIN b USING (user_id, event_type) WHERE a.event_id <> b.event_id
        UNION ALL
        SELECT b.*, 'update_postimage' FROM b JOIN a USING (user_id, event_type) WHERE a.event_id <> b.event_id
    )
    SELECT *, CAST(1 AS BIGINT) AS _commit_version, TIMESTAMP '{T1}' AS _commit_timestamp FROM tagged
""")
def change_feed_between(spark: SparkSession, root: str) -> DataFrame:
    before, after = _state(spark, root, DAYS[0]), _state(spark, root, DAYS[2], drop_type=True)
    return cdc.change_feed(before, after, PAIR, 1, _at(T1))


@query(f"""
    WITH a AS ({_state_sql(DAYS[2])}), tagged AS (
        SELECT *, 'delete' AS _change_type FROM a WHERE user_id % 499 = 7
        UNION ALL SELECT *, 'update_preimage' FROM a WHERE user_id % 499 = 5
        UNION ALL SELECT * REPLACE (value + 1 AS value), 'update_postimage' FROM a WHERE user_id % 499 = 5
        UNION ALL SELECT * REPLACE (-user_id AS user_id), 'insert' FROM a WHERE user_id % 499 = 9
    )
    SELECT *, CAST(1 AS BIGINT) AS _commit_version, TIMESTAMP '{T1}' AS _commit_timestamp FROM tagged
""")
def change_feed_by_digest(spark: SparkSession, root: str) -> DataFrame:
    """Two stored snapshots of which most buckets are alike; only the others are read to be joined."""
    before, kind = _state(spark, root, None), F.col("user_id") % 499
    after = before.where(kind != 7).withColumn("value", F.when(kind == 5, F.col("value") + 1).otherwise(F.col("value")))
    after = after.unionByName(before.where(kind == 9).withColumn("user_id", -F.col("user_id")))
    table = Snapshots(new_area(spark, "snapshots"), before.schema, PAIR, buckets=32)
    table.store(before, 0)
    table.store(after, 1)
    return table.changes(spark, 0, 1, 1, _at(T1))


@query(f"""
    WITH a AS ({_state_sql(DAYS[0])}), b AS ({_state_sql(DAYS[1])}), c AS ({_state_sql(DAYS[2])})
    SELECT c.*, CASE WHEN b.event_id IS DISTINCT FROM c.event_id THEN 2
                     WHEN a.event_id IS DISTINCT FROM b.event_id THEN 1 ELSE 0 END::BIGINT AS processed_version,
           CASE WHEN b.event_id IS DISTINCT FROM c.event_id THEN TIMESTAMP '{T1}'
                WHEN a.event_id IS DISTINCT FROM b.event_id THEN TIMESTAMP '{T2}' ELSE TIMESTAMP '{T0}'
           END AS processed_timestamp
    FROM c LEFT JOIN b USING (user_id, event_type) LEFT JOIN a USING (user_id, event_type)
""")
def cdf_upsert(spark: SparkSession, root: str) -> DataFrame:
    """The changes of two versions merged over the rows of an earlier one; the second was committed by a slow clock."""
    a, b, c = (_state(spark, root, day) for day in DAYS)
    feed = cdc.change_feed(a, b, PAIR, 1, _at(T2)).unionByName(cdc.change_feed(b, c, PAIR, 2, _at(T1)))
    stored = a.withColumn("processed_version", F.lit(0).cast("bigint")).withColumn("processed_timestamp", _at(T0))
    return cdc.cdf_upsert(stored, feed, PAIR)


@query(f"""
    WITH b AS ({_state_sql(DAYS[1])}), c AS ({_state_sql(DAYS[2])})
    SELECT c.*, 'insert' AS _change_type, CAST(2 AS BIGINT) AS _commit_version
    FROM c LEFT JOIN b USING (user_id, event_type) WHERE b.event_id IS NULL
    UNION ALL
    SELECT b.*, 'update_preimage', 2 FROM b JOIN c USING (user_id, event_type) WHERE b.event_id <> c.event_id
    UNION ALL
    SELECT c.*, 'update_postimage', 2 FROM b JOIN c USING (user_id, event_type) WHERE b.event_id <> c.event_id
""")
def change_feed_versions(spark: SparkSession, root: str) -> DataFrame:
    """A stored change feed read from a version on."""
    area = new_area(spark, "versions")
    states = [_state(spark, root, day) for day in DAYS]
    for version, (before, after) in enumerate(zip(states, states[1:]), 1):
        write_batch(cdc.change_feed(before, after, PAIR, version, _at(T1)), area, version)
    changes = read_batches(spark, area).drop("batch_id")
    return cdc.between_versions(changes, 2, 2).drop("_commit_timestamp")


@query(_state_sql(DAYS[2], True))
def replay_changes(spark: SparkSession, root: str) -> DataFrame:
    """A snapshot and the changes after it give the later snapshot."""
    before, after = _state(spark, root, DAYS[0]), _state(spark, root, DAYS[2], drop_type=True)
    return cdc.replay(before, cdc.change_feed(before, after, PAIR, 1, _at(T1)), PAIR)


@query(f"""
    SELECT event_type, event_id, value, CASE WHEN event_type <> 'view' THEN user_id END AS user_id,
           CASE WHEN event_type <> '{LATE_TYPE}' THEN ts END AS ts
    FROM events WHERE event_type IN ('view', '{LATE_TYPE}')
""")
def unsequenced_rows(spark: SparkSession, root: str) -> DataFrame:
    """Changes that lack their key or their sequence are set apart, not lost."""
    log = _log(spark, root).withColumns({
        "user_id": F.when(F.col("event_type") != "view", F.col("user_id")),
        "ts": F.when(F.col("event_type") != LATE_TYPE, F.col("ts")),
    })
    return scd.unsequenced(log, USER, "ts")


@query(latest_sql("user_id"))
def merge_upsert_newer(spark: SparkSession, root: str) -> DataFrame:
    log = _loads(spark, root)
    target, source = (scd.scd1_build(part, USER, "ts") for part in (_part(log, 0, 1), _part(log, 1, 2)))
    return merge.merge_upsert(target, source, USER, "ts")


@query(latest_sql("user_id, event_type"))
def merge_upsert_composite(spark: SparkSession, root: str) -> DataFrame:
    """The older rows come as the source: they may add keys but must not replace newer rows."""
    log = _loads(spark, root)
    target, source = (scd.scd1_build(part, PAIR, "ts") for part in (_part(log, 1, 2), _part(log, 0)))
    return merge.merge_upsert(target, source, PAIR, "ts")


@query("""
    SELECT o_orderkey, o_orderdate, o_custkey,
           CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN o_totalprice ELSE -o_totalprice END AS o_totalprice
    FROM orders
""")
def insert_only_merge(spark: SparkSession, root: str) -> DataFrame:
    """A redelivered order, here with another price, leaves the stored one as it is."""
    orders = read_table(spark, root, "orders").select("o_orderkey", "o_orderdate", "o_custkey", "o_totalprice")
    stored = orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    offered = orders.where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    changed = offered.withColumn("o_totalprice", -F.col("o_totalprice"))
    return merge.merge_insert_only(stored, changed.unionByName(changed), ["o_orderkey", "o_orderdate"])


@query("""
    SELECT o_orderkey, o_orderdate, o_custkey,
           CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN o_totalprice ELSE -o_totalprice END AS o_totalprice
    FROM orders
""")
def insert_only_filtered(spark: SparkSession, root: str) -> DataFrame:
    """The same merge into a stored table whose keys are in a Bloom filter: only possible matches are looked up."""
    area, keys = new_area(spark, "filtered"), ["o_orderkey", "o_orderdate"]
    orders = read_table(spark, root, "orders").select(*keys, "o_custkey", "o_totalprice")
    first = orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    offered = orders.where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    offered = offered.withColumn("o_totalprice", -F.col("o_totalprice"))
    known = KeyFilter(f"{area}/filter", keys, slots_for(orders.count()))
    for number, batch in enumerate((first, offered.unionByName(offered))):
        if number:
            batch = new_rows(spark.read.schema(orders.schema).parquet(f"{area}/table"), batch, keys, known)
            batch.write.parquet(f"{area}/new")
            batch = spark.read.schema(orders.schema).parquet(f"{area}/new")
        known.add(batch, number)
        batch.write.mode("append").parquet(f"{area}/table")
    return spark.read.schema(orders.schema).parquet(f"{area}/table")


@query("SELECT event_type AS topic, max(ts) AS last_processed_ts FROM events GROUP BY event_type")
def watermark_advance(spark: SparkSession, root: str) -> DataFrame:
    """Marks start empty and advance with two overlapping slices, the older one last."""
    log = _loads(spark, root)
    marks = merge.start_marks(spark, TOPICS, "timestamp_ntz")
    for part in (_part(log, 1, 2), _part(log, 0, 1)):
        marks = merge.advance_marks(marks, part, "event_type", "ts")
    return marks


@query("""
    SELECT event_type AS topic, CASE WHEN event_type = 'click' THEN (SELECT max(ts) FROM events) ELSE min(ts) END
           AS last_processed_ts
    FROM events GROUP BY event_type
""")
def mark_update(spark: SparkSession, root: str) -> DataFrame:
    """UPDATE of one tracked row by key, from a scalar subquery."""
    rows = events(spark, root)
    marks = rows.groupBy(F.col("event_type").alias("topic")).agg(F.min("ts").alias("last_processed_ts"))
    newest = rows.agg(F.max("ts")).scalar()
    return merge.update_where(marks, F.col("topic") == "click", last_processed_ts=newest)


def late_sql(delay: str, lag: int, schedule: str = LATE_LOAD_SQL) -> str:
    return f"""
        WITH log AS (SELECT *, CAST({schedule} AS BIGINT) AS load FROM events),
        peaks AS (SELECT load, max(ts) AS peak FROM log GROUP BY load),
        marks AS (
            SELECT load, max(peak) OVER (ORDER BY load ROWS BETWEEN UNBOUNDED PRECEDING AND {lag} PRECEDING)
                   - INTERVAL {delay} AS mark
            FROM peaks
        )
        SELECT user_id, event_type, event_id, ts, value, load FROM log JOIN marks USING (load) WHERE ts <= mark
    """
