"""Run-to-completion streams and their sinks on plain Parquet.

What a micro-batch writes goes to a folder named after its streaming query and its number, and replaces whatever an
interrupted attempt left there. A query keeps its id as long as its checkpoint lives, so a replayed batch finds its own
folder, while another stream, or the same one on a new checkpoint, never touches it. Nothing that is read is overwritten.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tierflow.operators.changes import change_feed
from tierflow.operators.skew import greatest_row
from tierflow.session import new_area
from tierflow.sources.tables import no_rows, read_batches

#: Folder of batches that no stream writes.
BY_HAND = "batch"
#: Partition column of tables that are laid out by key.
BUCKET = "key_bucket"
RANGES = "query string, low int, high int"
#: Buckets of a stored table unless it says otherwise; few suit small tables, as many as there are large files large ones.
BUCKETS = 16


def run_stream(
    df: DataFrame, path: str, checkpoint: str, mode: str = "append", partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append a stream's backlog to a Parquet table and stop."""
    writer = df.writeStream.format("parquet").outputMode(mode).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


#: What a run's batches did about late rows.
PROGRESS = "query string, batch bigint, watermark timestamp, rows_dropped bigint"


def keep_progress(query: StreamingQuery, path: str) -> None:
    """Append to a table what a finished run dropped: per batch, the watermark it ran with and the rows behind it.

    Spark keeps the last `spark.sql.streaming.numRecentProgressUpdates` batches of a run (100 by default).
    """
    spark, rows = SparkSession.active(), []
    for batch in query.recentProgress:
        mark = (batch["eventTime"] or {}).get("watermark")
        dropped = sum(o["numRowsDroppedByWatermark"] for o in batch["stateOperators"])
        rows.append((str(query.id), batch["batchId"], mark, dropped))
    df = spark.createDataFrame(rows, "query string, batch bigint, watermark string, rows_dropped bigint")
    df.withColumn("watermark", F.col("watermark").cast("timestamp")).coalesce(1).write.mode("append").parquet(path)


def each_batch(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Give every micro-batch of the backlog to `write` and stop."""
    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def writer_id(batch: DataFrame) -> str:
    """The id of the streaming query whose micro-batch this is; it outlives restarts from the same checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or BY_HAND


def write_batch(batch: DataFrame, path: str, number: int, partition_by: Sequence[str] = ()) -> None:
    """Append one numbered batch of the stream (or hand) that runs; writing the same number again replaces it."""
    writer = batch.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/query={writer_id(batch)}/batch_id={number}")


def write_audited(batch: DataFrame, path: str, number: int, ts: str, audit_path: str) -> None:
    """`write_batch`, with the batch's rows, least and greatest `ts` noted in an audit table while they pass to the writer."""
    kind, noted = batch.schema[ts].dataType, Observation()
    seen = batch.observe(noted, F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    write_batch(seen, path, number)
    schema = T.StructType().add("n_rows", T.LongType()).add("first_ts", kind).add("last_ts", kind)
    row = [noted.get[c] for c in schema.names]
    write_batch(batch.sparkSession.createDataFrame([row], schema).coalesce(1), audit_path, number)


def append_batches(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Append each micro-batch, after `prepare`, to a table that `read_batches` reads."""

    def write(batch: DataFrame, number: int) -> None:
        write_batch(prepare(batch) if prepare else batch, path, number, partition_by)

    return each_batch(df, write, checkpoint)


def found(read: Callable[[], DataFrame]) -> DataFrame | None:
    """A table, or None while nothing has been written to its place."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def bucket_of(columns: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def touched_buckets(rows: DataFrame, columns: Sequence[str], buckets: int) -> list[int]:
    """The buckets of a batch's keys: `buckets` numbers at most, from the batch's own rows."""
    return sorted(r[0] for r in rows.select(bucket_of(columns, buckets)).distinct().collect())


def number_ranges(batches: DataFrame, known: Iterable[Row] = ()) -> list[tuple[str, int, int]]:
    """(query, low, high): runs of consecutive batch numbers, in `batches` or `known` already.

    A stream has one run as long as none of its batches is left out, so few rows come to the driver.
    """
    numbers = batches.select("query", "batch_id").distinct()
    place = F.row_number().over(Window.partitionBy("query").orderBy("batch_id"))
    runs = numbers.withColumn("run", F.col("batch_id") - place).groupBy("query", "run")
    found = runs.agg(F.min("batch_id").alias("low"), F.max("batch_id").alias("high")).drop("run").collect()
    merged: list[tuple[str, int, int]] = []
    for query, low, high in sorted((r.query, r.low, r.high) for r in [*found, *known]):
        if merged and merged[-1][0] == query and low <= merged[-1][2] + 1:
            merged[-1] = (query, merged[-1][1], max(high, merged[-1][2]))
        else:
            merged.append((query, low, high))
    return merged


def outside(ranges: Iterable[Row]) -> Column:
    """Batches that are in none of the ranges; a filter on partition columns, so that no file of theirs is opened."""
    within = [(F.col("query") == r.query) & F.col("batch_id").between(r.low, r.high) for r in ranges]
    return ~reduce(or_, within, F.lit(False))


def feed_of(schema: T.StructType) -> T.StructType:
    """The columns of a table's change feed."""
    kinds = (("_change_type", T.StringType()), ("_commit_version", T.LongType()), ("_commit_timestamp", T.TimestampType()))
    return T.StructType([*schema.fields, *(T.StructField(*k) for k in kinds)])


def changes_stream(spark: SparkSession, path: str, schema: T.StructType, below: str = "") -> DataFrame:
    """The change feed of a table with `schema`, written in numbered batches, as a stream."""
    return spark.readStream.schema(feed_of(schema)).parquet(f"{path}/query=*/batch_id=*{below}")


@dataclass(frozen=True)
class KeyedLog:
    """A table with unique keys, kept as an append-only log of reduced batches; the greatest row of a key counts.

    Rows are compared by `order_by`, then by all other columns; with `first` the least one counts instead, by the number
    of the batch that brought it, so that what came first stays. A batch costs its own rows, however large the table is.

    Batches, changes and the compacted base are laid out by `buckets` hashes of `bucket_by` (some of the keys; all
    without it), so `read_for`, `track` and `changes_for` open the buckets of the keys they are asked about and no others.
    The number of buckets stays as it is for the life of the table; choose it so that a bucket is a few files.
    `compact` stores the reduced table, which readers then start from; batches it holds are not read again.
    """

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    order_by: tuple[str, ...] = ()
    first: bool = False
    bucket_by: tuple[str, ...] = ()
    buckets: int = BUCKETS

    def __post_init__(self) -> None:
        if not set(self.bucket_by) <= set(self.keys):
            raise ValueError("rows of one key must share a bucket: bucket_by takes keys only")

    @property
    def feed_schema(self) -> T.StructType:
        """What `changes_path` holds."""
        return feed_of(self.schema)

    def _batches(self, spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
        """Batches with stream, number and bucket; None while there are no files."""
        rows = found(lambda: read_batches(spark, path, keep_query=True, schema=schema))
        return rows if rows is not None and BUCKET in rows.columns else None

    @property
    def log_path(self) -> str:
        return f"{self.path}/log"

    @property
    def changes_path(self) -> str:
        return f"{self.path}/changes"

    @property
    def placed_by(self) -> tuple[str, ...]:
        return self.bucket_by or self.keys

    def append(self, batch: DataFrame, number: int) -> None:
        """Add one micro-batch, one row per key."""
        self.put(self.reduced(batch.select(*self.schema.names)), self.log_path, number)

    def put(self, rows: DataFrame, path: str, number: int) -> None:
        """Write a batch by bucket: small buckets share a task, a large one is cut."""
        placed = rows.withColumn(BUCKET, bucket_of(self.placed_by, self.buckets)).hint("rebalance", F.col(BUCKET))
        write_batch(placed, path, number, [BUCKET])

    def reduced(self, rows: DataFrame) -> DataFrame:
        if not self.first:
            return greatest_row(rows.select(*self.schema.names), self.keys, self.order_by)
        arrival = -F.col("batch_id") if "batch_id" in rows.columns else F.lit(0)
        firsts = rows.select(*self.schema.names, arrival.alias("_first"))
        return greatest_row(firsts, self.keys, ["_first"]).select(*self.schema.names)

    def read(self, spark: SparkSession) -> DataFrame:
        rows = self._rows(spark)
        return no_rows(spark, self.schema) if rows is None else self.reduced(rows)

    def read_for(self, some: DataFrame, on: Sequence[str] = (), before: tuple[str, int] | None = None) -> DataFrame:
        """The table's rows whose `on` (by default what places them) occurs in `some`; only their buckets are read.

        With `before` (a stream and a number) the table as it was before that stream's batch.
        """
        spark, on = some.sparkSession, list(on or self.placed_by)
        if self._batches(spark, self.log_path, self.schema) is None:
            return no_rows(spark, self.schema)
        rows = self._rows(spark, touched_buckets(some, self.placed_by, self.buckets), before)
        if rows is None:
            return no_rows(spark, self.schema)
        return self.reduced(rows.join(some.select(*on).distinct(), on, "left_semi"))

    def changes_for(self, some: DataFrame) -> DataFrame | None:
        """The change feed of the keys in `some`, from their buckets; None while there is no feed."""
        on = list(self.placed_by)
        changes = self._batches(some.sparkSession, self.changes_path, self.feed_schema)
        if changes is None:
            return None
        rows = changes.where(F.col(BUCKET).isin(touched_buckets(some, on, self.buckets))).select(*self.feed_schema.names)
        return rows.join(some.select(*on).distinct(), on, "left_semi")

    def stream_changes(self, spark: SparkSession) -> DataFrame:
        """The change feed as a stream; a batch replayed after a failure may appear twice."""
        return changes_stream(spark, self.changes_path, self.schema, f"/{BUCKET}=*")

    def _rows(
        self, spark: SparkSession, of: list[int] | None = None, before: tuple[str, int] | None = None
    ) -> DataFrame | None:
        """The compacted rows and the batches that came since, of some buckets or all; they may hold several rows of a key."""
        log = self._batches(spark, self.log_path, self.schema)
        if log is None:
            return None
        wanted = F.lit(True) if of is None else F.col(BUCKET).isin(of)
        later = F.lit(False)
        if before is not None:
            later = (F.col("query") == before[0]) & (F.col("batch_id") >= before[1])
        version, held = self._base(spark, before)
        rows = log.where(wanted & ~later & outside(held)).select(*self.schema.names, "batch_id")
        if version is None:
            return rows
        base = spark.read.schema(self.schema).parquet(f"{self.path}/base/version={version}").where(wanted)
        return base.select(*self.schema.names, F.lit(-1).alias("batch_id")).unionByName(rows)

    def _base(self, spark: SparkSession, before: tuple[str, int] | None = None) -> tuple[int | None, list[Row]]:
        """The newest compacted version, without batches that are not `before`, and the ranges of batches it holds."""
        done = found(lambda: spark.read.parquet(f"{self.path}/compacted"))
        held = [] if done is None else done.collect()  # a row per stream and version
        usable = {r.version for r in held} - {
            r.version for r in held if before and r.query == before[0] and r.high >= before[1]
        }
        newest = max(usable, default=None)
        return newest, [r for r in held if r.version == newest]

    def compact(self, spark: SparkSession) -> None:
        """Store the table as it is. Readers see it once the ranges of its batches are written, which comes last."""
        batches, rows = self._batches(spark, self.log_path, self.schema), self._rows(spark)
        if batches is None:
            return
        # Listed before the rows: a batch that comes in between is in the base and, harmlessly, read once more.
        held = spark.createDataFrame(number_ranges(batches), RANGES)
        done = found(lambda: spark.read.parquet(f"{self.path}/compacted"))
        version = 0 if done is None else done.agg(F.max("version")).first()[0] + 1
        placed = self.reduced(rows).withColumn(BUCKET, bucket_of(self.placed_by, self.buckets)).hint("rebalance", F.col(BUCKET))
        placed.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/base/version={version}")
        held.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/compacted/version={version}")

    def track(self, batch: DataFrame, number: int) -> None:
        """Append a batch and leave the changes it makes in `changes_path`.

        Only rows of the batch's keys are compared, read from their buckets. Versions go on from those of other queries, so
        that a new checkpoint continues them, and a replayed batch gives its own again.
        """
        spark = batch.sparkSession
        mine, place = writer_id(batch), new_area(spark, "tracked")
        # The batch is computed once, into a table of its own.
        self.reduced(batch.select(*self.schema.names)).write.parquet(f"{place}/new")
        new = spark.read.schema(self.schema).parquet(f"{place}/new")
        self.read_for(new, self.keys, (mine, number)).write.parquet(f"{place}/known")
        known = spark.read.schema(self.schema).parquet(f"{place}/known")
        changes = self._batches(spark, self.changes_path, self.feed_schema)
        others = None if changes is None else changes.where(F.col("query") != mine).agg(F.max("_commit_version")).first()[0]
        version = (0 if others is None else others + 1) + number
        after = self.reduced(known.unionByName(new))
        self.put(change_feed(known, after, self.keys, version), self.changes_path, number)
        self.put(new, self.log_path, number)


def log_stream(df: DataFrame, table: KeyedLog, checkpoint: str, changes: bool = False,
               prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Fold a stream into a keyed table, micro-batch by micro-batch; with `changes` its change feed is kept too."""

    def write(batch: DataFrame, number: int) -> None:
        (table.track if changes else table.append)(prepare(batch) if prepare else batch, number)

    return each_batch(df, write, checkpoint)
