"""Event-time operators; each also accepts a bounded DataFrame, where the watermark has no effect."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup_stream(df: DataFrame, keys: Sequence[str], ts: str, delay: str, salts: int = 1) -> DataFrame:
    """First row of each key; state is dropped once `ts` (one of the keys) is `delay` behind.

    One key's copies all reach one state partition. With `salts` > 1 each input task's copies are first reduced
    in one of that many partitions, so at most `salts` rows of a key ever meet; this costs a second state.
    """
    rows = df.withWatermark(ts, delay)
    if salts > 1:
        salted = rows.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        rows = salted.dropDuplicates([*keys, "_salt"]).drop("_salt")
    return rows.dropDuplicates(list(keys))


def tumbling_stats(
    df: DataFrame,
    ts: str,
    width: str,
    keys: Sequence[str],
    count_col: str,
    avg_col: str,
    delay: str | None = None,
) -> DataFrame:
    """Count and average per window and key; combined map-side, so hot keys arrive pre-aggregated."""
    rows = df.withWatermark(ts, delay) if delay else df
    return (
        rows.groupBy(F.window(ts, width).alias("time"), *keys)
        .agg(F.count(count_col).alias("n_rows"), F.avg(avg_col).alias("avg_value"))
        .select(F.col("time.start").alias("window_start"), F.col("time.end").alias("window_end"), *keys,
                "n_rows", "avg_value")
    )


@dataclass(frozen=True)
class TimeBound:
    """Rows match only if their event times differ by at most `within`; rows later than `delay` are dropped."""

    left_ts: str
    right_ts: str
    delay: str
    within: str

    @property
    def condition(self) -> Column:
        reach = F.expr(f"INTERVAL {self.within}")
        left, right = F.col(self.left_ts), F.col(self.right_ts)
        return (right >= left - reach) & (right <= left + reach)


def stream_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], bound: TimeBound | None = None, salts: int = 1
) -> DataFrame:
    """Inner join of two streams that share only the `keys` columns.

    Without a bound every row of both sides is kept as state for good. A bound lets state expire and leaves out
    the pairs further apart than it says. `salts` spreads one key's left rows over that many state partitions
    and copies each right row to all of them: use it when left keys are hot and the right side is small per key.
    """
    on = list(keys)
    if bound:
        left = left.withWatermark(bound.left_ts, bound.delay)
        right = right.withWatermark(bound.right_ts, bound.delay)
    if salts > 1:
        spread = [c for c in left.columns if c not in on]
        left = left.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
        right = right.withColumn("_salt", F.explode(F.array(*[F.lit(s) for s in range(salts)])))
        on = [*on, "_salt"]
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    condition = F.lit(True) if bound is None else bound.condition
    for column in on:
        condition = condition & (F.col(column) == F.col(f"_r_{column}"))
    joined = left.join(renamed, condition, "inner")
    return joined.drop("_salt", *[f"_r_{c}" for c in on])
