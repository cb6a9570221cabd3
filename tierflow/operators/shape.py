"""Row shape: conforming to a declared schema, nesting, flattening, lookups and lineage-safe unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(
    df: DataFrame, schema: T.StructType | str, required: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Columns cast to a declared schema; rows with NULL in a required column come second, as they were.

    Fields declared NOT NULL are required as well. A value that cannot be cast counts as NULL. Rejected rows keep their
    own values, so that they can be repaired; `missing` names the required columns they lack.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    needed = [f.name for f in schema.fields if f.name in required or not f.nullable]
    cast = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    missing = F.concat_ws(",", *[F.when(cast[c].isNull(), c) for c in needed])
    good = df.where(missing == "").select(*[c.alias(n) for n, c in cast.items()])
    return good, df.withColumn("missing", missing).where("missing <> ''")


def union_widened(*frames: DataFrame) -> DataFrame:
    """Union by name; columns that a frame lacks are NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def lookup_join(df: DataFrame, dim: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner join with a lookup; rows without a match are dropped.

    No broadcast hint: Spark broadcasts the lookup when its size is under the threshold, and otherwise
    shuffles, splitting skewed keys.
    """
    return df.join(dim, F.col(left_key) == F.col(right_key), "inner")


def nest_lines(lines: DataFrame, keys: Sequence[str], fields: Sequence[str], position: str, name: str) -> DataFrame:
    """One row per key with an array of structs, ordered by `position`.

    A nested row is one row by definition, so a key's lines must fit in one.
    """
    item = F.struct(F.col(position), *[F.col(f) for f in fields if f != position])
    return lines.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias(name))


def order_lines(orders: DataFrame, items: DataFrame, array_col: str, item_key: str, right_key: str) -> DataFrame:
    """One row per array element with the item's columns; the element's fields become `line_<field>`.

    Orders without elements and elements without an item give no row.
    """
    fields = orders.schema[array_col].dataType.elementType.names
    flat = orders.withColumn("_line", F.explode(array_col)).select(
        *[c for c in orders.columns if c != array_col],
        *[F.col(f"_line.{f}").alias(f"line_{f}") for f in fields],
    )
    return flat.join(items, F.col(f"line_{item_key}") == F.col(right_key), "inner")
