"""Stored interval tables: open and closed versions apart, each file listed with the span of time it covers.

A change touches the open version of its key, or, when it comes late, a closed version that ends after it. So versions
live in files by state (open, closed) and bucket of the key, and a manifest lists for every file its bucket, its least
start and its greatest end. An apply reads the open files of the buckets that the batch touches and those closed files that
end after the batch's earliest row in their bucket; it writes what becomes of their rows to new files, and then a manifest
with the new files in place of the old ones. Other files are neither read nor written, and no reader reduces anything.

The manifest of a refresh is written last and in one file; a refresh that stopped before is done again under its number.
Files that no manifest lists any more are not removed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.operators.scd import scd2_build, split_by_batch
from tierflow.session import new_area
from tierflow.sources.tables import no_rows, read_batches
from tierflow.streaming.sinks import BUCKET, BUCKETS, RANGES, bucket_of, found, number_ranges, outside

STATE, OPEN, CLOSED = "state", "open", "closed"
#: What a manifest says of a file; its other rows are ranges of applied batches.
FILE = ("file", STATE, BUCKET, "first_start", "last_end", "n_rows")


@dataclass(frozen=True)
class IntervalTable:
    """Validity intervals of the rows of a change log, one version per (keys, `sequence_by`).

    `buckets` stays as it is for the life of the table. `file_rows` bounds the rows of a file; rows of a file are neighbours
    by end, so that few closed files reach into a late row's time.
    """

    path: str
    keys: tuple[str, ...]
    sequence_by: str
    buckets: int = BUCKETS
    file_rows: int = 1_000_000

    def refresh(self, spark: SparkSession, log_path: str) -> DataFrame:
        """Bring the table up to the batches of a log that came since the last refresh; an empty log gives an empty table."""
        log = found(lambda: read_batches(spark, log_path, keep_query=True))
        if log is None:
            raise ValueError(f"there is no change log at {log_path}")
        number, listed = self._manifest(spark)
        held = [] if listed is None else listed.where("query IS NOT NULL").select("query", "low", "high").collect()
        news = log.where(outside(held))
        rows = news.drop("query", "batch_id")
        sequenced = rows.dropna(subset=[*self.keys, self.sequence_by])
        schema = scd2_build(rows.limit(0), self.keys, self.sequence_by).schema
        if not rows.isEmpty():
            applied = spark.createDataFrame(number_ranges(news, held), RANGES)
            self._apply(spark, sequenced, number + 1, listed, applied, schema)
        return self.read(spark, schema)

    def _apply(
        self, spark: SparkSession, rows: DataFrame, number: int, listed: DataFrame | None, applied: DataFrame, schema: T.StructType
    ) -> None:
        earliest = rows.groupBy(bucket_of(self.keys, self.buckets).alias(BUCKET)).agg(F.min(self.sequence_by).alias("at"))
        kind = rows.schema[self.sequence_by].dataType
        # A row per bucket at most.
        reach = spark.createDataFrame(earliest.collect(), T.StructType().add(BUCKET, T.IntegerType()).add("at", kind))
        files = self._no_files(spark, kind) if listed is None else listed.where("file IS NOT NULL").select(*FILE)
        faced = files.join(reach, BUCKET).where((F.col(STATE) == OPEN) | (F.col("last_end") > F.col("at")))
        names = [r.file for r in faced.select("file").collect()]
        place = new_area(spark, "reopened")
        if names:
            stored = spark.read.schema(schema).parquet(*names)
            settled, log = split_by_batch(stored, rows, self.keys, self.sequence_by)
            log.write.parquet(place)
            rebuilt = scd2_build(spark.read.schema(log.schema).parquet(place), self.keys, self.sequence_by)
            versions = settled.unionByName(rebuilt)
        else:
            versions = scd2_build(rows, self.keys, self.sequence_by)
        data = f"{self.path}/data/refresh={number}"
        placed = versions.withColumn(STATE, F.when(F.col("is_active"), OPEN).otherwise(CLOSED)).withColumn(
            BUCKET, bucket_of(self.keys, self.buckets)
        )
        # By bucket, in the order of ends; a bucket too large for one task is cut, and so are its files.
        writer = placed.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(STATE, BUCKET, "end_date").write
        writer.mode("overwrite").option("maxRecordsPerFile", self.file_rows).partitionBy(STATE, BUCKET).parquet(data)
        written = found(lambda: spark.read.parquet(data))
        entries = files.join(spark.createDataFrame([(n,) for n in names], "file string"), "file", "left_anti")
        if written is not None:
            entries = entries.unionByName(
                written.groupBy(F.col("_metadata.file_path").alias("file"), STATE, BUCKET).agg(
                    F.min("start_date").alias("first_start"), F.max("end_date").alias("last_end"), F.count(F.lit(1)).alias("n_rows")
                )
            )
        entries.unionByName(applied, allowMissingColumns=True).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/manifest/refresh={number}"
        )

    def _no_files(self, spark: SparkSession, kind: T.DataType) -> DataFrame:
        schema = T.StructType().add("file", T.StringType()).add(STATE, T.StringType()).add(BUCKET, T.IntegerType())
        return no_rows(spark, schema.add("first_start", kind).add("last_end", kind).add("n_rows", T.LongType()))

    def _manifest(self, spark: SparkSession) -> tuple[int, DataFrame | None]:
        """The number of the last finished refresh, -1 before the first, and what it lists: files, and ranges of batches."""
        every = found(lambda: spark.read.parquet(f"{self.path}/manifest"))
        if every is None:
            return -1, None
        number = every.agg(F.max("refresh")).first()[0]
        return number, spark.read.parquet(f"{self.path}/manifest/refresh={number}")

    def files(self, spark: SparkSession, where: Column | None = None) -> list[Row]:
        """The live files with state, bucket, span and rows; a row per file."""
        _, listed = self._manifest(spark)
        if listed is None:
            return []
        files = listed.where("file IS NOT NULL").select(*FILE)
        return (files if where is None else files.where(where)).collect()

    def _versions(self, spark: SparkSession, schema: T.StructType | None, where: Column | None = None) -> DataFrame:
        if schema is None:
            schema = spark.read.parquet(f"{self.path}/data").drop("refresh", STATE, BUCKET).schema
        names = [r.file for r in self.files(spark, where)]
        return spark.read.schema(schema).parquet(*names) if names else no_rows(spark, schema)

    def read(self, spark: SparkSession, schema: T.StructType | None = None) -> DataFrame:
        return self._versions(spark, schema)

    def current(self, spark: SparkSession) -> DataFrame:
        """The open versions; no closed file is read."""
        return self._versions(spark, None, F.col(STATE) == OPEN)

    def as_of(self, spark: SparkSession, ts: Column) -> DataFrame:
        """Versions valid at `ts`, from the files whose span holds it."""
        rows = self._versions(spark, None, (F.col("first_start") <= ts) & ((F.col(STATE) == OPEN) | (F.col("last_end") > ts)))
        return rows.where((F.col("start_date") <= ts) & (F.col("is_active") | (ts < F.col("end_date"))))
