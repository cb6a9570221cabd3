"""Connected components of a graph given by its edges, as a few relational steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """(member, root) for every node of `edges` (a, b: bigint); root is the smallest node of its component.

    Alternates two steps until the edges no longer change: each node links its larger neighbours to its smallest
    neighbour, then its smaller neighbours and itself to that one. Neighbourhoods are only aggregated, never collected,
    and joined by plain exchanges, so a star with very many leaves is no burden to one task.
    """
    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    seen = signature(now)
    while True:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("m")).agg(F.least(F.min("b"), F.min("a")).alias("low"))
        wide = (
            both.where("b > a").join(least, F.col("a") == F.col("m")).where("b > low")
            .select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        )
        wide = stored(wide, "edges")
        least = wide.groupBy(F.col("a").alias("m")).agg(F.min("b").alias("low"))
        narrow = wide.join(least, F.col("a") == F.col("m"))
        now = stored(
            narrow.where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
            .unionAll(least.select(F.col("m").alias("a"), F.col("low").alias("b")))
            .distinct(),
            "edges",
        )
        before, seen = seen, signature(now)
        if before == seen:
            break
    return now.select(F.col("a").alias("member"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("member"), F.col("b").alias("root")).distinct()
    )


def signature(edges: DataFrame) -> tuple[int, int]:
    """Equal for equal sets of edges, and with probability 2^-64 for different ones of one size."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
