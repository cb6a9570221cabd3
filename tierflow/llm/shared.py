"""Tables written once to the shared folder, and columns kept apart from the caller's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.session import new_area

#: What separates words, as a Java pattern.
BLANK = r"[\x20\x09-\x0D]"


#: Removes what a query has shuffled as soon as the query ends, instead of when the driver collects garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of `df` from a table in the shared folder: cuts lineage and survives lost executors.

    What was shuffled for them is removed once they are written.
    """
    spark, path = df.sparkSession, new_area(df.sparkSession, label)
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)


def row_of(df: DataFrame) -> Column:
    """All columns of a row as one struct, so that no helper column can clash with them."""
    return F.struct(*[F.col(quoted(c)) for c in df.columns])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def parallelism(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def remainder(id_col: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


#: A sieve has so many rows of 32,768 bits each at most: a fixed bound of 4 MB.
SIEVE_ROWS, ROW_BITS = 1024, 1 << 15


def sieve_place(key: Column) -> tuple[Column, Column]:
    place = F.pmod(F.xxhash64(key), F.lit(SIEVE_ROWS * ROW_BITS))
    return F.shiftright(place, 15).cast("int"), F.pmod(place, F.lit(ROW_BITS))


def sieve(keys: DataFrame, key: Column) -> DataFrame:
    """A bitmap of the hashes of `key`, of a fixed size bound, for `sifted`."""
    row, bit = sieve_place(key)
    return keys.groupBy(row.alias("s_row")).agg(F.bitmap_construct_agg(bit).alias("s_bits"))


def sifted(df: DataFrame, key: Column, bits: DataFrame, name: str) -> DataFrame:
    """`df` with column `name`: false where `key` is surely not among the keys of the sieve.

    It spares rows that have no partner a shuffle; rows that may have one still need the exact join. When there are so
    many keys that the bitmap fills up, it spares nothing, and the result is the same.
    """
    row, bit = sieve_place(key)
    byte = F.conv(F.hex(F.substring("s_bits", (F.shiftright(bit, 3) + 1).cast("int"), 1)), 16, 10).cast("int")
    hit = F.coalesce(byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), F.pmod(bit, F.lit(8)).cast("int"))) != 0, F.lit(False))
    joined = df.withColumn("s_at", row).join(F.broadcast(bits), F.col("s_at") == F.col("s_row"), "left")
    return joined.withColumn(name, hit).drop("s_at", "s_row", "s_bits")
