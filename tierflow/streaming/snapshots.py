"""Numbered snapshots of a keyed table, compared by digests of their buckets before any rows are."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.operators.changes import bucket_digests, change_feed, differing_buckets
from tierflow.streaming.sinks import BUCKET, bucket_of


@dataclass(frozen=True)
class Snapshots:
    """Whole states of a table, unique on `keys`, laid out by `buckets` hashes of the keys.

    Each bucket's digest is stored beside the rows, so two snapshots are compared by a few numbers per bucket; rows are read
    and joined only in the buckets that differ. What does not change costs nothing, however large it is.
    """

    path: str
    schema: T.StructType
    keys: Sequence[str]
    buckets: int = 64

    def store(self, rows: DataFrame, number: int) -> None:
        """Write a snapshot and then its digests; doing it again replaces both."""
        spark, place = rows.sparkSession, f"{self.path}/rows/number={number}"
        placed = rows.select(*self.schema.names).withColumn(BUCKET, bucket_of(self.keys, self.buckets)).hint("rebalance", F.col(BUCKET))
        placed.write.mode("overwrite").partitionBy(BUCKET).parquet(place)
        digests = bucket_digests(self.read(spark, number), self.keys, self.buckets)
        digests.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/digests/number={number}")

    def read(self, spark: SparkSession, number: int, of: list[int] | None = None) -> DataFrame:
        """A snapshot, or some of its buckets."""
        rows = spark.read.schema(self.schema).parquet(f"{self.path}/rows/number={number}")
        return (rows if of is None else rows.where(F.col(BUCKET).isin(of))).select(*self.schema.names)

    def digests(self, spark: SparkSession, number: int) -> DataFrame:
        return spark.read.parquet(f"{self.path}/digests/number={number}")

    def changes(self, spark: SparkSession, first: int, last: int, version: int, committed: Column | None = None) -> DataFrame:
        """`change_feed` from one snapshot to another."""
        of = differing_buckets(self.digests(spark, first), self.digests(spark, last))
        return change_feed(self.read(spark, first, of), self.read(spark, last, of), self.keys, version, committed)
