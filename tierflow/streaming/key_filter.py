"""A stored Bloom filter of a table's keys, so that an insert-only merge looks up possible matches alone.

The filter is blocked: a key's hash chooses one slot, a bitmap of 4 KB, and `probes` bits in it, so a test is one lookup by
slot. Slots are rows of a table: batches add theirs, readers combine them, and both are plain aggregates and joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.operators.skew import greatest_row
from tierflow.session import new_area
from tierflow.sources.tables import no_rows, read_batches
from tierflow.streaming.sinks import found, write_batch

SLOT_BITS = 1 << 15
SLOTS = T.StructType().add("slot", T.LongType()).add("bits", T.BinaryType())


def slots_for(rows: int, bits_per_key: float = 12) -> int:
    """Slots for so many keys; at twelve bits a key about one in 150 absent keys passes as possible."""
    return max(1, -int(-rows * bits_per_key // SLOT_BITS))


@dataclass(frozen=True)
class KeyFilter:
    """The keys of a table in `slots` bitmaps, a number that stays. With more keys than it was made for it lets more pass.

    Add a batch to the filter before its rows are stored: then no stored key is ever missing from it.
    """

    path: str
    keys: Sequence[str]
    slots: int
    probes: int = 4

    def _slot(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.slots))

    def _bits(self) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(n), *self.keys), F.lit(SLOT_BITS)) for n in range(self.probes)]

    def add(self, rows: DataFrame, number: int) -> None:
        """Enter the keys of a numbered batch: at most a bitmap per slot is written, whatever the batch holds."""
        bits = rows.select(self._slot().alias("slot"), F.explode(F.array(*self._bits())).alias("bit"))
        write_batch(bits.groupBy("slot").agg(F.bitmap_construct_agg("bit").alias("bits")), self.path, number)

    def read(self, spark: SparkSession) -> DataFrame:
        batches = found(lambda: read_batches(spark, self.path, schema=SLOTS))
        rows = no_rows(spark, SLOTS) if batches is None else batches
        return rows.groupBy("slot").agg(F.bitmap_or_agg("bits").alias("bits"))

    def tested(self, rows: DataFrame, name: str) -> DataFrame:
        """`rows` with column `name`: false for keys that were surely never added."""

        def is_set(bit: Column) -> Column:
            byte = F.conv(F.hex(F.substring("_f_bits", (F.shiftright(bit, 3) + 1).cast("int"), 1)), 16, 10).cast("int")
            return F.getbit(byte.cast("bigint"), F.pmod(bit, F.lit(8)).cast("int")) == 1

        slots = self.read(rows.sparkSession).select(F.col("slot").alias("_f_slot"), F.col("bits").alias("_f_bits"))
        joined = rows.withColumn("_slot", self._slot()).join(slots, F.col("_slot") == F.col("_f_slot"), "left")
        hit = F.coalesce(reduce(and_, map(is_set, self._bits())), F.lit(False))
        return joined.withColumn(name, hit).drop("_slot", "_f_slot", "_f_bits")


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], known: KeyFilter) -> DataFrame:
    """The source rows whose key the target lacks, the greatest of each key.

    Rows that the filter knows to be new pass at once. The others, few unless they are stored already, are looked up: the
    target's keys meet them, not the whole batch, in a semi join that adaptive execution broadcasts when they are few.
    """
    spark, place = target.sparkSession, new_area(target.sparkSession, "offered")
    # Tested once, into a table of its own.
    tested = known.tested(greatest_row(source.select(*target.columns), keys), "_possible")
    tested.write.parquet(place)
    offered = spark.read.schema(tested.schema).parquet(place)
    possible = offered.where("_possible").drop("_possible")
    stored = target.select(*keys).join(possible.select(*keys), list(keys), "left_semi").distinct()
    return offered.where("NOT _possible").drop("_possible").unionByName(possible.join(stored, list(keys), "left_anti"))
