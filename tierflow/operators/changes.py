"""Change feeds between snapshots, version ranges, reads by load number, and load audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.operators.merge import absent_from
from tierflow.operators.skew import greatest_row

# The kinds of change and the ones that carry a new row.
INSERT, BEFORE, AFTER, DELETE = "insert", "update_preimage", "update_postimage", "delete"
NEW_ROWS = (INSERT, AFTER)


def change_feed(
    before: DataFrame, after: DataFrame, keys: Sequence[str], version: int, committed: Column | None = None
) -> DataFrame:
    """Row changes that turn `before` into `after`; both are unique on `keys` and have the same columns.

    Adds `_change_type`, `_commit_version` and `_commit_timestamp`.
    """
    columns = before.columns
    old = before.select(*keys, F.struct(*columns).alias("_old"))
    new = after.select(*keys, F.struct(*columns).alias("_new"))
    pairs = old.join(new, list(keys), "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new")))

    def image(kind: str, row: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(row).alias("row"))

    images = (
        F.when(F.col("_old").isNull(), F.array(image(INSERT, "_new")))
        .when(F.col("_new").isNull(), F.array(image(DELETE, "_old")))
        .otherwise(F.array(image(BEFORE, "_old"), image(AFTER, "_new")))
    )
    stamp = F.current_timestamp() if committed is None else committed
    return pairs.select(F.inline(images)).select(
        "row.*",
        F.col("kind").alias("_change_type"),
        F.lit(version).cast("bigint").alias("_commit_version"),
        stamp.alias("_commit_timestamp"),
    )


def bucket_digests(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """(bucket, n_rows, d_xor, d_sum): what the rows of each hash bucket of the keys come to, whatever their order.

    Different sets of rows give equal digests only by a chance of about 2^-64 each for the xor and the sum of their hashes.
    """
    row = F.xxhash64(*rows.columns)
    hashed = rows.select(F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"), row.alias("_hash"))
    return hashed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_rows"), F.bit_xor("_hash").alias("d_xor"), F.sum(F.col("_hash").cast("decimal(20,0)")).alias("d_sum")
    )


def differing_buckets(before: DataFrame, after: DataFrame) -> list[int]:
    """The buckets whose `bucket_digests` differ or are there once only; a number per bucket comes to the driver."""
    tagged = before.withColumn("_side", F.lit(1)).unionByName(after.withColumn("_side", F.lit(2)))
    same = tagged.groupBy("bucket", "n_rows", "d_xor", "d_sum").agg(F.sum("_side").alias("_sides")).where("_sides <> 3")
    return sorted(r.bucket for r in same.select("bucket").distinct().collect())


def replay(before: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The snapshot after the changes of one version."""
    keys = list(keys)
    gone = changes.where(F.col("_change_type").isin(BEFORE, DELETE)).select(*keys)
    fresh = changes.where(F.col("_change_type").isin(*NEW_ROWS)).select(*before.columns)
    return before.join(gone, keys, "left_anti").unionByName(fresh)


#: Commits are ordered by version; the time only tells when.
COMMIT = ("_commit_version", "_commit_timestamp")


def between_versions(changes: DataFrame, first: int, last: int | None = None) -> DataFrame:
    """The changes of versions `first` to `last`, both included; all from `first` on without `last`."""
    wanted = F.col("_commit_version") >= first
    return changes.where(wanted if last is None else wanted & (F.col("_commit_version") <= last))


def newest_images(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last committed new image per key, with its commit as `processed_version` and `processed_timestamp`."""
    images = changes.where(F.col("_change_type").isin(*NEW_ROWS)).drop("_change_type")
    return greatest_row(images, keys, COMMIT).withColumnsRenamed(
        {"_commit_version": "processed_version", "_commit_timestamp": "processed_timestamp"}
    )


def cdf_upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge the newest images of a change feed over rows that carry the commit they were processed at.

    A stored row gives way to an image of a later version, or of the same version and a later time.
    """
    columns = target.columns
    images = newest_images(changes, keys).select(*columns)
    offered = images.select(*keys, F.struct(*columns).alias("_new"))
    later = F.struct("_new.processed_version", "_new.processed_timestamp") > F.struct("processed_version", "processed_timestamp")
    replace = F.coalesce(F.col("_new").isNotNull() & later, F.lit(False))
    kept = target.join(offered, list(keys), "left").select(
        *[F.when(replace, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    )
    return kept.unionByName(absent_from(images, target, keys))


def up_to_version(log: DataFrame, version_col: str, version: int) -> DataFrame:
    """The rows loaded up to a version; a table state is rebuilt from them."""
    return log.where(F.col(version_col) <= version)


def load_history(log: DataFrame, batch_col: str, ts_col: str) -> DataFrame:
    """One audit row per load."""
    return log.groupBy(batch_col).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(ts_col).alias("first_ts"), F.max(ts_col).alias("last_ts")
    )


def latest_load(log: DataFrame, batch_col: str) -> DataFrame:
    """Rows of the newest load only."""
    return log.where(F.col(batch_col) == log.agg(F.max(batch_col).alias("_newest")).scalar())
