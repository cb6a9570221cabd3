"""Parquet tables as bounded or unbounded DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def stream_table(spark: SparkSession, root: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """The table as a stream, be it one file or a folder of part files.

    A plain file path is refused by the file stream source; a one-letter glob accepts both forms.
    """
    if schema is None:
        schema = read_table(spark, root, name).schema
    return spark.readStream.schema(schema).parquet(f"{root}/{name}.parque[t]")


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table that the optimizer knows to be empty, so that joins with it vanish."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_batches(
    spark: SparkSession, path: str, keep_query: bool = False, schema: T.StructType | None = None
) -> DataFrame:
    """A table of numbered batches with the number of each row's batch; `keep_query` also tells which query wrote it.

    With its `schema` (without partition columns) no file is opened to find it out.
    """
    reader = spark.read.option("basePath", path)
    table = (reader.schema(schema) if schema else reader).parquet(f"{path}/query=*")
    return table.withColumn("query", F.col("query").cast("string")) if keep_query else table.drop("query")


def zoned(df: DataFrame, *columns: str) -> DataFrame:
    """Plain timestamps as instants, which watermarks need."""
    for column in columns:
        df = df.withColumn(column, F.col(column).cast("timestamp"))
    return df


def read_lookup(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A JSON lookup; give the schema to avoid the extra pass that inferring it costs."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)
