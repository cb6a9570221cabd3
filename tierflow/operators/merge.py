"""MERGE, UPDATE and incremental slices as joins over snapshots.

An upsert never shuffles a large target for a small batch: the batch is the build side of a left join, which adaptive
execution broadcasts when its measured size allows and sort-merges otherwise. New keys are found by one anti join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.skew import greatest_row

# Fixed value: the mark of an empty target.
FIRST_TS = "1900-01-01 00:00:00"


def absent_from(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks (a NULL key is never found)."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], newer_col: str | None = None) -> DataFrame:
    """Update matched rows, insert the others. `source` has one row per key.

    With `newer_col` a matched row is replaced only if the target's value is smaller, so on a tie the target stays.
    """
    columns = target.columns
    incoming = source.select(*columns)
    offered = incoming.select(*keys, F.struct(*columns).alias("_new"))
    replace = F.col("_new").isNotNull()
    if newer_col:
        replace = replace & (F.col(newer_col) < F.col(f"_new.{newer_col}"))
    kept = target.join(offered, list(keys), "left").select(
        *[F.when(replace, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    )
    return kept.unionByName(absent_from(incoming, target, keys))


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows untouched, plus the source rows whose key it lacks. `source` has one row per key."""
    return target.unionByName(absent_from(source.select(*target.columns), target, keys))


def merge_insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As `insert_absent`, for a source that may hold copies of a key: its greatest row counts."""
    return insert_absent(target, greatest_row(source.select(*target.columns), keys), keys)


def update_where(df: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """UPDATE … SET … WHERE … as a projection."""
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})


def incremental_slice(source: DataFrame, target: DataFrame, ts_col: str, first: str = FIRST_TS) -> DataFrame:
    """Source rows above the target's high-water mark, or above `first` while the target is empty.

    The mark is a scalar subquery: it stays in the plan and its value reaches the scan filter.
    """
    kind = source.schema[ts_col].dataType
    mark = target.agg(F.coalesce(F.max(ts_col), F.lit(first).cast(kind)).alias("_mark"))
    return source.where(F.col(ts_col) > mark.scalar())


def start_marks(spark: SparkSession, topics: Sequence[str], ts_type: str = "timestamp") -> DataFrame:
    """One row per topic with no mark yet."""
    names = F.explode(F.array(*[F.lit(t) for t in topics])).alias("topic")
    return spark.range(1).select(names, F.lit(None).cast(ts_type).alias("last_processed_ts"))


def advance_marks(marks: DataFrame, source: DataFrame, topic_col: str, ts_col: str) -> DataFrame:
    """Move each topic's mark up to the newest `ts_col` seen; marks never move back."""
    seen = source.groupBy(F.col(topic_col).alias("topic")).agg(F.max(ts_col).alias("last_processed_ts"))
    return marks.unionByName(seen).groupBy("topic").agg(F.max("last_processed_ts").alias("last_processed_ts"))
