"""Reductions, distincts, orderings and set operations over change rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.operators.skew import greatest_row

#: 2^bits registers in a sketch of distinct keys.
SKETCH_BITS = 14


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_by: str, ties: str = "all", where: Column | None = None
) -> DataFrame:
    """Rows with the greatest `order_by` of their key.

    ties="one": a single row per key, ties broken by the remaining columns.
    ties="all": every row that rank() = 1 would give. All rows of a key may tie, so no window gathers them: each key's
    maximum, one row per key and map task in its shuffle, meets the rows in a semi join, which adaptive execution
    broadcasts when the keys are few and otherwise splits where a key is hot.
    """
    if where is not None:
        df = df.where(where)
    if ties == "one":
        return greatest_row(df, keys, [order_by])
    if ties != "all":
        raise ValueError(f"ties must be 'all' or 'one', not {ties!r}")
    # A NULL is the maximum only where a key has nothing else, as it is for rank().
    top = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max(order_by).alias("_top"))
    same_key = [df[k].eqNullSafe(top[f"_{k}"]) for k in keys]
    return df.join(top, reduce(and_, [*same_key, df[order_by].eqNullSafe(top["_top"])]), "left_semi")


def count_rows(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))


def count_keys(df: DataFrame, keys: Sequence[str], *by: str, exact: bool = True) -> DataFrame:
    """Number of distinct non-NULL keys, exact or (opt-in) estimated; `key_sketches` keeps what can be added up."""
    counted = F.count_distinct(*keys) if exact else F.approx_count_distinct(F.struct(*keys))
    return df.groupBy(*by).agg(counted.alias("n_keys"))


def key_sketches(df: DataFrame, keys: Sequence[str], *by: str, bits: int = SKETCH_BITS) -> DataFrame:
    """A sketch of the distinct non-NULL keys of each group, of a fixed size, that `keys_of_sketches` adds up."""
    known = reduce(and_, (F.col(k).isNotNull() for k in keys))
    key = F.when(known, F.xxhash64(*keys))
    return df.groupBy(*by).agg(F.hll_sketch_agg(key, F.lit(bits)).alias("keys_sketch"))


def keys_of_sketches(sketches: DataFrame, *by: str) -> DataFrame:
    """Estimated number of distinct keys of the union of the sketches in each group.

    Keys that several sketches saw count once. The relative standard error is about 1.04 / sqrt(2^bits), 0.8 % for 14 bits.
    """
    merged = F.hll_sketch_estimate(F.hll_union_agg("keys_sketch"))
    return sketches.groupBy(*by).agg(merged.alias("n_keys"))


def string_agg(df: DataFrame, by: Sequence[str], item: Column, name: str, sep: str = ",") -> DataFrame:
    """Distinct items of each group in ascending order as one string.

    Copies fold map-side before anything is collected, so a group costs its distinct items only.
    """
    pairs = df.select(*by, item.alias("_item")).distinct()
    return pairs.groupBy(*by).agg(F.concat_ws(sep, F.array_sort(F.collect_list("_item"))).alias(name))


def in_given_order(column: str, categories: Sequence[str]) -> Column:
    """Sort key that follows `categories`; values outside the list sort last."""
    place = F.array_position(F.array(*[F.lit(c) for c in categories]), F.col(column))
    return F.when(place > 0, place).otherwise(len(categories) + 1)
