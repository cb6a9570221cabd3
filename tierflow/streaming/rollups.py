"""Gold statistics kept by deltas: sums and counts per group, changed by what a change feed takes away and adds.

For facts joined with a dimension, statistics of the join change in two ways. Changed facts meet the dimension as it stands;
changed dimension rows meet the facts that are stored for their keys. A row that a change takes away counts -1, a row that it
brings counts 1, so an update is both. Only changes are read, and of the stored sides only the buckets of their keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.operators.changes import BEFORE, DELETE, NEW_ROWS
from tierflow.sources.tables import no_rows, read_batches
from tierflow.streaming.sinks import BUCKETS, KeyedLog, found, number_ranges, outside, write_batch

SIGN = "_sign"
#: Sums are kept exactly, so that what is added and taken away again leaves nothing.
EXACT = "decimal(38,6)"
COUNTS = ("n_rows", "n_values")
#: Where deltas come from: changed facts, or changed rows of the dimension.
FACTS, DIMENSION = PARTS = ("facts", "dimension")


def signed(changes: DataFrame) -> DataFrame:
    """Rows of a change feed with `_sign`: -1 for a row that goes, 1 for a row that comes."""
    kind = F.col("_change_type")
    sign = F.when(kind.isin(*NEW_ROWS), 1).when(kind.isin(BEFORE, DELETE), -1).cast("bigint")
    return changes.withColumn(SIGN, sign).drop("_change_type", "_commit_version", "_commit_timestamp")


@dataclass(frozen=True)
class DeltaStats:
    """Rows, values and their exact sum per group, as an append-only table of deltas that `read` adds up.

    A batch costs one row per group that it touches. `fold` replaces the deltas so far by their sums. A group whose rows are
    all gone is gone.
    """

    path: str
    groups: T.StructType

    @property
    def schema(self) -> T.StructType:
        added = [T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField("sum_value", T.DecimalType(38, 6))]
        return T.StructType([*self.groups.fields, *added])

    def add(self, rows: DataFrame, value: str, number: int, part: str) -> None:
        """Take in signed rows with the group columns; writing the same number of the same part again replaces it."""
        exact = F.col(value).cast(EXACT)
        deltas = rows.groupBy(*self.groups.names).agg(
            F.sum(SIGN).alias("n_rows"), F.sum(F.when(exact.isNotNull(), F.col(SIGN)).otherwise(0)).alias("n_values"),
            F.coalesce(F.sum(F.when(F.col(SIGN) > 0, exact).otherwise(-exact)), F.lit(0)).cast(EXACT).alias("sum_value"),
        )
        changed = deltas.where("n_rows <> 0 OR n_values <> 0 OR sum_value <> 0")
        write_batch(changed, f"{self.path}/{part}", number)

    def _deltas(self, spark: SparkSession, part: str) -> DataFrame | None:
        rows = found(lambda: read_batches(spark, f"{self.path}/{part}", keep_query=True, schema=self.schema))
        return rows if rows is not None and "batch_id" in rows.columns else None

    def _summed(self, deltas: DataFrame) -> DataFrame:
        sums = [F.sum(c).alias(c) for c in COUNTS] + [F.sum("sum_value").cast(EXACT).alias("sum_value")]
        return deltas.groupBy(*self.groups.names).agg(*sums).where("n_rows <> 0")

    def _rows(self, spark: SparkSession) -> DataFrame:
        version, held = self._folded(spark)
        rows = no_rows(spark, self.schema)
        if version is not None:
            rows = spark.read.schema(self.schema).parquet(f"{self.path}/folded/version={version}")
        for part in PARTS:
            deltas = self._deltas(spark, part)
            if deltas is not None:
                rows = rows.unionByName(deltas.where(outside([r for r in held if r.part == part])).select(*self.schema.names))
        return rows

    def read(self, spark: SparkSession) -> DataFrame:
        """Groups with `n_rows`, `n_values`, `sum_value`, and `avg_value` of the values that are not null."""
        average = F.when(F.col("n_values") != 0, F.col("sum_value").cast("double") / F.col("n_values"))
        return self._summed(self._rows(spark)).withColumn("avg_value", average)

    def _folded(self, spark: SparkSession) -> tuple[int | None, list[Row]]:
        done = found(lambda: spark.read.parquet(f"{self.path}/folds"))
        held = [] if done is None else done.collect()  # a row per stream and fold
        newest = max((r.version for r in held), default=None)
        return newest, [r for r in held if r.version == newest]

    def fold(self, spark: SparkSession) -> None:
        """Store the sums as they are; readers start from them once the list of what they hold is written, which comes last.

        Every delta must count once, so fold between micro-batches, not during one.
        """
        parts = {part: self._deltas(spark, part) for part in PARTS}
        ranges = [(part, *r) for part, rows in parts.items() if rows is not None for r in number_ranges(rows)]
        if not ranges:
            return
        version = (self._folded(spark)[0] or 0) + 1
        self._summed(self._rows(spark)).write.mode("overwrite").parquet(f"{self.path}/folded/version={version}")
        spark.createDataFrame(ranges, "part string, query string, low int, high int").coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/folds/version={version}"
        )


@dataclass(frozen=True)
class JoinedStats:
    """Statistics of facts joined with a dimension by `on`, kept up to date by the change feeds of both.

    `facts` and `dimension` are the consumer's own copies of both sides as far as it has applied them: their keys, `live`
    (false for a row that went) and `_commit_version`, by which they are ordered; both are placed by `on`. A batch adds its
    deltas against the other side's copy and then enters its own, so one that is done again after a failure comes out alike.
    A fact whose `on` changes is another row of its copy, so `on` belongs to the keys of the facts.
    """

    stats: DeltaStats
    facts: KeyedLog
    dimension: KeyedLog
    on: str
    value: str

    def __post_init__(self) -> None:
        if {self.facts.placed_by, self.dimension.placed_by} != {(self.on,)}:
            raise ValueError("both sides must be placed by the join column")

    def fact_changes(self, batch: DataFrame, number: int) -> None:
        self._apply(batch, number, FACTS, self.facts, self.dimension)

    def dimension_changes(self, batch: DataFrame, number: int) -> None:
        self._apply(batch, number, DIMENSION, self.dimension, self.facts)

    def _apply(self, batch: DataFrame, number: int, part: str, own: KeyedLog, other: KeyedLog) -> None:
        standing = other.read_for(batch).where("live").drop("live", "_commit_version")
        self.stats.add(signed(batch).join(standing, self.on), self.value, number, part)
        own.append(batch.withColumn("live", F.col("_change_type").isin(*NEW_ROWS)), number)


def own_copy(path: str, side: T.StructType, keys: Sequence[str], on: str, buckets: int = BUCKETS) -> KeyedLog:
    """The copy of one side that `JoinedStats` keeps: of one commit the row that came counts, not the one that went."""
    schema = T.StructType([*side.fields, T.StructField("live", T.BooleanType()), T.StructField("_commit_version", T.LongType())])
    return KeyedLog(path, schema, tuple(keys), ("_commit_version", "live"), bucket_by=(on,), buckets=buckets)
