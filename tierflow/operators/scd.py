"""Slowly changing dimensions of type 1 (latest row) and type 2 (validity intervals).

Both are correct under late, repeated and multi-change batches: they depend on the set of change rows, not on
the order of arrival. Rows without a key or sequence never enter; `unsequenced` returns them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.operators.merge import merge_upsert
from tierflow.operators.reduce import latest_per_key
from tierflow.operators.skew import HOT_ROWS, next_sequence
from tierflow.session import new_area

INTERVAL = ("start_date", "end_date", "is_active")


def _sequenced(keys: Sequence[str], sequence_by: str) -> Column:
    return reduce(and_, (F.col(c).isNotNull() for c in [*keys, sequence_by]))


def unsequenced(log: DataFrame, keys: Sequence[str], sequence_by: str) -> DataFrame:
    return log.where(~_sequenced(keys, sequence_by))


def scd1_build(
    log: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    include_ops: Sequence[str] | None = None,
    op_col: str | None = None,
) -> DataFrame:
    """Latest row per key; ties in `sequence_by` go to the greatest remaining columns."""
    wanted = _sequenced(keys, sequence_by)
    if include_ops is not None:
        wanted = wanted & F.col(op_col).isin(*include_ops)
    return latest_per_key(log, keys, sequence_by, ties="one", where=wanted)


def scd1_apply(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    include_ops: Sequence[str] | None = None,
    op_col: str | None = None,
) -> DataFrame:
    """Upsert a batch: a key's row is replaced only by a greater sequence."""
    return merge_upsert(target, scd1_build(batch, keys, sequence_by, include_ops, op_col), keys, sequence_by)


def scd2_build(
    log: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    open_end: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One version per (keys, sequence) with half-open validity [start_date, end_date).

    Of rows with equal (keys, sequence) the greatest by the remaining columns counts. The open version's end is NULL,
    or `open_end` when given; `is_active` marks it either way.
    """
    rows = next_sequence(log.where(_sequenced(keys, sequence_by)), keys, sequence_by, "_next", hot_rows)
    versions = rows.where(F.col("_next").isNull() | (F.col("_next") > F.col(sequence_by)))
    end = F.col("_next") if open_end is None else F.coalesce("_next", open_end)
    attributes = [c for c in log.columns if c != sequence_by]
    return versions.select(
        *attributes,
        F.col(sequence_by).alias("start_date"),
        end.alias("end_date"),
        F.col("_next").isNull().alias("is_active"),
    )


def change_log(scd2: DataFrame, sequence_by: str) -> DataFrame:
    """The change rows an interval table was built from."""
    return scd2.withColumnRenamed("start_date", sequence_by).drop("end_date", "is_active")


def split_by_batch(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], sequence_by: str
) -> tuple[DataFrame, DataFrame]:
    """The versions a batch cannot touch, and the change rows from which the others are to be rebuilt.

    A version can change only if it ends after the earliest new sequence of its key. All other versions, and all
    keys absent from the batch, stay as they are and need no shuffle when the batch is small enough to broadcast.
    """
    batch = batch.where(_sequenced(keys, sequence_by))
    earliest = batch.groupBy(*keys).agg(F.min(sequence_by).alias("_earliest"))
    faced = target.join(earliest, list(keys), "left")
    settled = F.col("_earliest").isNull() | (~F.col("is_active") & (F.col("end_date") <= F.col("_earliest")))
    reopened = change_log(faced.where(~settled).drop("_earliest"), sequence_by)
    return faced.where(settled).select(*target.columns), reopened.unionByName(batch.select(*reopened.columns))


def scd2_apply(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    open_end: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Apply change rows to an interval table; equals one build over all changes ever applied.

    The rows to rebuild, those of the batch and the versions it can touch, are written first and read from there, so the
    target is read once for them and once for the versions that stay.
    """
    settled, log = split_by_batch(target, batch, keys, sequence_by)
    place = new_area(target.sparkSession, "reopened")
    log.write.parquet(place)
    log = target.sparkSession.read.schema(log.schema).parquet(place)
    return settled.unionByName(scd2_build(log, keys, sequence_by, open_end, hot_rows))


def current_rows(scd2: DataFrame) -> DataFrame:
    return scd2.where("is_active")


def as_of(scd2: DataFrame, ts: Column) -> DataFrame:
    """Versions valid at `ts`."""
    return scd2.where((F.col("start_date") <= ts) & (F.col("is_active") | (ts < F.col("end_date"))))


def flag_text(scd2: DataFrame, yes: str = "Y", no: str = "N") -> DataFrame:
    """The active flag as text, for readers that expect it so."""
    return scd2.withColumn("is_active", F.when(F.col("is_active"), yes).otherwise(no))
