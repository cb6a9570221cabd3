"""Column expressions shared by the feed, table and streaming code; all JVM-side."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ingest_stamp(zone: str = "UTC") -> Column:
    """Wall clock of `zone` at query start; one value for all rows of a run."""
    return F.from_utc_timestamp(F.current_timestamp(), zone)


def ingest_stamp_text(zone: str = "UTC", pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """The same moment as `ingest_stamp` in the same query, as text."""
    return F.date_format(ingest_stamp(zone), pattern)


def wall_clock(ts: Column, zone: str) -> Column:
    """UTC instant shown on the clock of `zone`."""
    return F.from_utc_timestamp(ts, zone)


def from_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def to_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def text(binary: Column) -> Column:
    """UTF-8 bytes as a string."""
    return binary.cast("string")


def parse_ts(value: Column, pattern: str) -> Column:
    return F.to_timestamp(value, pattern)


def show_ts(ts: Column, pattern: str) -> Column:
    return F.date_format(ts, pattern)


def all_null(struct: Column, schema: T.StructType) -> Column:
    """True when no field of the struct carries a value."""
    return reduce(and_, (struct[f.name].isNull() for f in schema.fields))


def clock_free(df: DataFrame) -> DataFrame:
    """Zoned timestamps as plain wall-clock timestamps, so that results do not depend on the session zone."""
    zoned = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
    return df.select(
        *[F.col(c).cast("timestamp_ntz").alias(c) if c in zoned else F.col(c) for c in df.columns]
    )
