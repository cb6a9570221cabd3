"""Finding and splitting keys that hold too many rows for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.session import new_area

#: A key with more rows than one task should sort is cut into ranges of about this many rows.
HOT_ROWS = 4_000_000
#: Rows sampled per range to find where to cut.
SAMPLED = 16
#: Ranges of one key at most, as a power of two: far more than a key of any table can need.
RANGE_BITS = 24


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys (NULL is one) with more than `hot_rows` rows, as `_key` (struct) and `_rows`.

    Counts are combined map-side and read the key columns only.
    """
    sizes = df.groupBy(key_struct(keys).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    return sizes.where(F.col("_rows") > hot_rows)


def key_struct(keys: Sequence[str]) -> Column:
    """The key as one value that is never NULL, so that NULL keys join and group like any other."""
    return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])


def next_sequence(
    df: DataFrame, keys: Sequence[str], seq: str, name: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every row with the `seq` of the row after it in column `name`, NULL on a key's last row.

    Rows of a key stand in the order of `seq` (NULL first), then of all other columns; NULL keys are one key. The result
    does not depend on `hot_rows`: rows of ordinary keys take one shuffle and one sort; those of keys above the limit
    are cut into ranges of that same order, whatever its types, and each range is closed by the start of the next one.
    The few keys above the limit, if any, are found in a first pass over the key columns and kept as a small stored
    table, which Spark broadcasts or shuffles by its size.
    """
    spark = df.sparkSession
    place = new_area(spark, "hot-keys")
    hot_keys(df, keys, hot_rows).write.parquet(place)
    hot = spark.read.parquet(place)
    ordered = Window.partitionBy(*keys).orderBy(*_order(df, keys, seq))
    if hot.isEmpty():
        return df.withColumn(name, F.lead(seq).over(ordered))
    keyed = df.withColumn("_key", key_struct(keys))
    cold = keyed.join(hot, "_key", "left_anti").drop("_key").withColumn(name, F.lead(seq).over(ordered))
    return cold.unionByName(_lead_in_ranges(keyed.join(hot, "_key"), keys, seq, name, hot_rows))


def _order(df: DataFrame, keys: Sequence[str], seq: str) -> list[Column]:
    return [F.col(c).asc() for c in (seq, *tie_columns(df, [*keys, seq, "_key", "_rows"]))]


def _lead_in_ranges(df: DataFrame, keys: Sequence[str], seq: str, name: str, hot_rows: int) -> DataFrame:
    """As `next_sequence`, for rows that all belong to hot keys and know their key's number of `_rows`."""
    spark = df.sparkSession
    ties = tie_columns(df, [*keys, seq, "_key", "_rows"])
    # A number of its own makes even equal rows differ, so that a pile of copies is cut as well.
    at = F.struct(F.col(seq).alias("seq"), *[F.col(c) for c in ties], F.monotonically_increasing_id().alias("_nr"))
    place = new_area(spark, "hot-rows")
    df.withColumn("_at", at).write.parquet(place)
    rows = spark.read.parquet(place)
    chance = F.least(F.lit(1.0), F.lit(float(SAMPLED)) / hot_rows)
    drawn = F.pmod(F.xxhash64("_at"), F.lit(1 << 30)) < chance * (1 << 30)
    every = F.row_number().over(Window.partitionBy("_key").orderBy("_at"))
    cuts = (
        rows.where(drawn).select("_key", "_at", every.alias("_n")).where(F.col("_n") % SAMPLED == 0)
        .groupBy("_key").agg(F.array_sort(F.collect_list("_at")).alias("_cuts"))
    )
    slotted = rows.join(cuts, "_key", "left").withColumn(
        "_slot", F.when(F.col("_cuts").isNull(), 0).otherwise(_count_below("_cuts", "_at"))
    ).drop("_cuts")
    # One row per range from here on.
    starts = slotted.groupBy("_key", "_slot").agg(F.min("_at").alias("_start"))
    following = F.lead("_start").over(Window.partitionBy("_key").orderBy("_slot"))
    after = starts.select(F.col("_key").alias("_s_key"), F.col("_slot").alias("_s_slot"), following.alias("_after"))
    in_range = Window.partitionBy("_key", "_slot").orderBy("_at")
    inside = slotted.select("*", F.lead(F.struct(seq)).over(in_range).alias("_inside"))
    closed = inside.join(after, (F.col("_key") == F.col("_s_key")) & (F.col("_slot") == F.col("_s_slot")))
    value = F.when(F.col("_inside").isNotNull(), F.col(f"_inside.{seq}")).otherwise(F.col("_after.seq"))
    kept = [c for c in df.columns if c not in ("_key", "_rows")]
    return closed.select(*kept, value.alias(name))


def _count_below(cuts: str, value: str) -> Column:
    """How many of the ascending `cuts` are below `value`, by binary search."""
    steps = F.array(*[F.lit(1 << e) for e in reversed(range(RANGE_BITS))])

    def advance(at, step):
        return F.when(F.get(cuts, at + step - 1) < F.col(value), at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), advance)


def greatest_row(df: DataFrame, groups: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The one greatest row of each group, by `order` and then by all other columns.

    Spark keeps only the first row per group in each map task before the shuffle, so a hot group or a pile
    of copies shrinks to one row per task.
    """
    ranking = [*order, *tie_columns(df, [*groups, *order])]
    if not ranking:
        return df.dropDuplicates(list(groups))
    best = Window.partitionBy(*groups).orderBy(*[F.col(c).desc() for c in ranking])
    return df.withColumn("_place", F.row_number().over(best)).where("_place = 1").drop("_place")


def tie_columns(df: DataFrame, used: Sequence[str]) -> list[str]:
    """Columns that can break ties (maps cannot be ordered)."""
    return [f.name for f in df.schema.fields if f.name not in used and f.dataType.typeName() != "map"]
