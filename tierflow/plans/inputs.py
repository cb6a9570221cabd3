"""The tables as message feeds and loads: what a landing folder would hold if they came in over time."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.scalars import to_millis
from tierflow.session import new_area
from tierflow.sources.feed import land_feed
from tierflow.sources.registry import Topic
from tierflow.sources.tables import read_table

PAYLOAD = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, value DOUBLE, props STRING"
TOPICS = ("click", "error", "purchase", "signup", "view")
EVENT_TOPICS = {t: Topic(t, PAYLOAD, ("user_id",), "ts", required=("event_id", "ts")) for t in TOPICS}

# Three loads by event time.
LOAD_ENDS = ("2024-01-11", "2024-01-21")
LOAD_SQL = (
    f"CASE WHEN ts < TIMESTAMP '{LOAD_ENDS[0]}' THEN 0 WHEN ts < TIMESTAMP '{LOAD_ENDS[1]}' THEN 1 ELSE 2 END"
)
# In the late schedules there are two loads by event time, but one event type comes one or two loads later.
LATE_TYPE = "error"
HALF_SQL = "CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END"
LATE_LOAD_SQL, LATER_LOAD_SQL = (
    f"({HALF_SQL} + CASE WHEN event_type = '{LATE_TYPE}' THEN {n} ELSE 0 END)" for n in (1, 2)
)
LATE_LOADS = range(3)


def events(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "events")


def loads(spark: SparkSession, root: str, schedule: str = LOAD_SQL) -> DataFrame:
    """Events with the number of the load that brings them."""
    return events(spark, root).withColumn("load", F.expr(schedule).cast("bigint"))


def load_numbers(log: DataFrame) -> list[int]:
    """The loads that bring any of the rows, first to last; a schedule has a handful of them."""
    return [r.load for r in log.select("load").distinct().sort("load").collect()]


def envelopes(rows: DataFrame, topic: Column | None = None, value: Column | None = None) -> DataFrame:
    """Events as feed envelopes; `topic` and `value` replace the regular ones."""
    payload = F.to_json(F.struct("event_id", F.col("ts").cast("string").alias("ts"), "user_id", "value", "props"))
    return rows.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        (payload if value is None else F.coalesce(value, payload)).cast("binary").alias("value"),
        (F.col("event_type") if topic is None else topic).alias("topic"),
        F.pmod("user_id", F.lit(8)).alias("partition"),
        F.col("event_id").alias("offset"),
        to_millis(F.col("ts")).alias("timestamp"),
    )


def landed_feed(spark: SparkSession, root: str, label: str) -> str:
    """A landing folder with the whole events table as envelopes."""
    return land_feed(envelopes(events(spark, root)), new_area(spark, label) + "/landing")


def arrivals(df: DataFrame, path: str, numbers: Iterable[int], copies: int = 1) -> Iterable[int]:
    """Append the loads to `path` one after the other, yielding after each; `copies` repeats the delivery."""
    for number in numbers:
        rows = df.where(F.col("load") == number)
        reduce(DataFrame.union, [rows] * copies).write.mode("append").parquet(path)
        yield number
