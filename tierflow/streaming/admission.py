"""Loads of many files taken in whole: landing with a manifest, one load per micro-batch, and schemas that grow.

A load is a folder of files and, once it is complete, one entry in the manifest. Streams follow the manifest, whose files
are a row each, so that "one load at a time" is one file at a time there, while the load's own files are read by as many
tasks as they need. A load without an entry, because it is being written or its writer died, is not seen.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tierflow.streaming.sinks import each_batch, found

MANIFEST = "load BIGINT, n_rows BIGINT, n_files BIGINT, columns STRING"


@dataclass(frozen=True)
class Landing:
    """A folder into which numbered loads come, each in one `format`."""

    path: str
    format: str = "parquet"

    def place(self, load: int) -> str:
        return f"{self.path}/loads/load={load}"

    @property
    def files(self) -> str:
        """All loads' files, as a path for readers; entries are not asked for."""
        return f"{self.path}/loads/load=*"

    def entries(self, spark: SparkSession) -> DataFrame | None:
        """The manifest; None before the first load."""
        return found(lambda: spark.read.schema(MANIFEST).json(f"{self.path}/manifest/load=*"))

    def land(self, rows: DataFrame, load: int, files: int | None = None) -> None:
        """Write a load and then its entry. A load that has one stays as it is, so a repeated delivery changes nothing.

        With `files` the load has exactly that many, empty ones among them if rows are few. A stream that keeps state
        takes one load per micro-batch with `maxFilesPerTrigger` set to the same number.
        """
        spark = rows.sparkSession
        if found(lambda: spark.read.schema(MANIFEST).json(f"{self.path}/manifest/load={load}")) is not None:
            return
        noted, schema = Observation(), rows.schema
        seen = rows.observe(noted, F.count(F.lit(1)).alias("n_rows"))
        if files:
            seen = seen.repartition(files)
        seen.write.mode("overwrite").format(self.format).save(self.place(load))
        written = len(spark.read.schema(schema).format(self.format).load(self.place(load)).inputFiles())
        for _ in range(written, files or 0):
            rows.limit(0).coalesce(1).write.mode("append").format(self.format).save(self.place(load))
        values = (load, noted.get["n_rows"], max(written, files or 0), schema.json())
        entry = [F.lit(v).alias(f.name) for v, f in zip(values, T.StructType.fromDDL(MANIFEST))]
        spark.range(1).coalesce(1).select(*entry).write.mode("overwrite").json(f"{self.path}/manifest/load={load}")

    def admit(
        self,
        spark: SparkSession,
        read: Callable[[SparkSession, str], DataFrame],
        write: Callable[[DataFrame, int], None],
        checkpoint: str,
    ) -> StreamingQuery:
        """Give each load that waits to `write`, whole, in a micro-batch of its own, in the order of their entries.

        `read` opens a load's folder. A micro-batch that is repeated after a failure brings the same load under the same
        number. A load without rows has a micro-batch as well.
        """
        entries = spark.readStream.schema(MANIFEST).option("maxFilesPerTrigger", 1).json(f"{self.path}/manifest/load=*")

        def take(batch: DataFrame, number: int) -> None:
            for entry in batch.select("load").collect():  # the one file's one row
                write(read(batch.sparkSession, self.place(entry.load)), number)

        return each_batch(entries, take, checkpoint)

    def schemas(self, spark: SparkSession) -> list[T.StructType]:
        """The different schemas among the loads; data files are not opened."""
        entries = self.entries(spark)
        if entries is None:
            return []
        kinds = entries.groupBy(F.col("columns").alias("fields")).agg(F.min("load").alias("load"))
        return [schema_of(r.fields) for r in kinds.sort("load").collect()]


def schema_of(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both without loss and as which Parquet files of both can be read.

    Integers grow to longer ones, all but the longest to double, float to double, date to timestamp without zone, decimals
    in either part; structs, arrays and maps member by member. Other pairs are an error: nothing is turned to text.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return widened(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(wider(a.keyType, b.keyType), wider(a.valueType, b.valueType))
    if isinstance(a, INTEGERS) and isinstance(b, INTEGERS):
        return max(a, b, key=lambda t: INTEGERS.index(type(t)))
    kinds = {type(a), type(b)}
    if kinds <= {*INTEGERS[:3], T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        precision = max(a.precision - a.scale, b.precision - b.scale) + scale
        if precision <= 38:
            return T.DecimalType(precision, scale)
    raise ValueError(f"no type holds both {a.simpleString()} and {b.simpleString()}")


def widened(known: T.StructType, new: T.StructType) -> T.StructType:
    """All fields of both, those of `known` first, each in the wider of its types; any of them may be NULL.

    Names are compared as Spark does by default, without case; the first spelling stays.
    """
    offered = {f.name.lower(): f for f in new.fields}
    fields = []
    for field in known.fields:
        other = offered.pop(field.name.lower(), field)
        try:
            kind = wider(field.dataType, other.dataType)
        except ValueError as error:
            raise ValueError(f"{field.name}: {error}") from None
        fields.append(T.StructField(field.name, kind))
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in offered.values()])


@dataclass(frozen=True)
class SchemaLog:
    """The schemas a table has had, one numbered version each; kept beside the checkpoint of the stream that fills it."""

    path: str

    def versions(self, spark: SparkSession) -> list[T.StructType]:
        """Oldest first; as many as the table has grown."""
        rows = found(lambda: spark.read.schema("fields STRING, version INT").json(self.path))
        return [] if rows is None else [schema_of(r.fields) for r in rows.sort("version").collect()]

    def current(self, spark: SparkSession) -> T.StructType:
        return ([T.StructType()] + self.versions(spark))[-1]

    def widen(self, spark: SparkSession, *schemas: T.StructType) -> T.StructType:
        """Take in more schemas; a version is added if the table's changes by it."""
        versions = self.versions(spark)
        known = versions[-1] if versions else T.StructType()
        grown = reduce(widened, schemas, known)
        if grown != known:
            row = spark.range(1).coalesce(1).select(F.lit(grown.json()).alias("fields"))
            row.write.mode("overwrite").json(f"{self.path}/version={len(versions)}")
        return grown

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """The Parquet table under its newest schema: columns that older files lack are NULL, narrower values are widened."""
        return spark.read.schema(self.current(spark)).parquet(table)


def run_growing(
    spark: SparkSession,
    landing: Landing,
    log: SchemaLog,
    take: Callable[[DataFrame], StreamingQuery],
) -> StreamingQuery | None:
    """A run on a checkpoint that stays, over loads that may have more columns or wider types than the loads before.

    Before the stream starts, the schema is widened by what the manifest tells of the loads, and the source is opened under
    it. `take` starts the query, which must keep no state, and waits for it; None if nothing has landed yet. A load whose
    types do not go together with the table's stops the run before any row of it is taken.
    """
    schemas = landing.schemas(spark)
    if not schemas:
        return None
    return take(spark.readStream.schema(log.widen(spark, *schemas)).format(landing.format).load(landing.files))
