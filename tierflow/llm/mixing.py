"""Mixing sources to target weights along a curriculum.

Each source has a weight and a ramp: its share of the training stream changes linearly over time, w(t) = target (1 +
ramp (2t - 1)) for t in [0, 1]. Its cumulative demand D(t) = target (t + ramp (t^2 - t)) is the integral, and the word
at place c of the source's stream is read at time D^-1(c). Documents of a source stand in a fixed random order; a source
that owes more words than it has repeats the whole order, and the last repetition ends in the document that meets the
target. Sorting all of them by time gives the training order.

Scale: everything after counting words works on a few numbers per document. Places within a source are prefix sums taken
block by block: documents fall into blocks by the first digits of their order key, blocks are summed map-side, and only
sums of blocks run through a window per source, so a source of any size is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.shared import quoted, stored

WEIGHTS = (5, 2, 1)
RAMPS = (-0.5, 0.0, 0.5)
#: A document is read so many times at most.
REPEATS = 3
BLOCK_ROWS = 2_000


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def targets(sources: DataFrame) -> DataFrame:
    """`sources` (source, source_size) with rank, ramp and target.

    Sources in code point order, null last, weigh 5, 2, 1, repeating, and share all words; a target stops at `REPEATS`
    times the source's size and its excess goes to the others by weight. With sources ordered by how soon they fill,
    the level at which the rest settles follows from running sums. One row per source; no document passes through.
    """
    every = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(every) - 1) % len(WEIGHTS)

    def of(values: tuple) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), place + 1)

    ranked = sources.select(
        "source", "source_size", F.row_number().over(every).alias("rank"), of(WEIGHTS).alias("weight"), of(RAMPS).alias("ramp")
    )
    fills = Window.orderBy(F.col("source_size") * REPEATS / F.col("weight"), "rank")
    before, onward = fills.rowsBetween(Window.unboundedPreceding, -1), fills.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    filling = ranked.select(
        "*",
        (
            (F.sum("source_size").over(whole) - F.coalesce(F.sum(F.col("source_size") * REPEATS).over(before), F.lit(0)))
            / F.sum("weight").over(onward)
        ).alias("level"),
    )
    open_level = F.when(F.col("level") * F.col("weight") <= F.col("source_size") * REPEATS, F.col("level"))
    return filling.select(
        "source", "source_size", "ramp",
        F.least(
            (F.col("source_size") * REPEATS).cast("double"), F.max(open_level).over(whole) * F.col("weight")
        ).alias("target"),
    )


def curriculum(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", carry: bool = False
) -> DataFrame:
    """One row per row of `docs`: doc_id, source, size, source_size, target, ramp, begin, taken, position.

    `taken` is the number of words the mix reads from the document, repeats counted; `begin` its place in the source's
    order in words; `position` the time in [0, 1] of its first reading, null if it is not read. Null text has no words,
    null sources form one source, null ids are allowed. Rows that tie in id and size are interchangeable. Empty
    documents and sources take nothing. With `carry` each row's `text` comes along, through one shuffle by block; rows that
    tie are then told apart by it.
    """
    identity = F.col("doc_id").cast("string")
    rows = docs.select(
        F.col(quoted(doc_id)).alias("doc_id"),
        F.col(quoted(source)).alias("source"),
        word_count(F.col(quoted(text))).alias("size"),
        *([F.col(quoted(text)).alias("text")] if carry else []),
    ).withColumn("turn", F.md5(F.coalesce(identity, F.lit("")).cast("binary")))
    sized = stored(rows.drop("text"), "mix-sizes")
    more = ["text"] if carry else []
    sources = stored(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")), "mix-sources"
    )
    largest = sources.agg(F.max("rows")).first()[0] or 0
    digits = 1
    while 16**digits * BLOCK_ROWS < largest:
        digits += 1
    # A null source gets a key of its own, so that joins and windows agree on the partitioning.
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key")
    block = F.substring("turn", 1, digits).alias("block")
    keyed = sized.select("*", key, block)
    earlier = Window.partitionBy("b_key").orderBy("b_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = keyed.groupBy(F.col("key").alias("b_key"), F.col("block").alias("b_block")).agg(F.sum("size").alias("words"))
    blocks = blocks.select("b_key", "b_block", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))
    goals = targets(sources).select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("t_key"), "source_size", "target", "ramp"
    )
    blocks = stored(
        blocks.join(goals, F.col("b_key") == F.col("t_key")).drop("t_key"), "mix-blocks"
    )
    inside = (
        Window.partitionBy("key", "block").orderBy("turn", "doc_id", "size", *more).rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (rows.select("*", key, block) if carry else keyed).join(
        blocks.hint("merge"), (F.col("key") == F.col("b_key")) & (F.col("block") == F.col("b_block"))
    ).withColumn("begin", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    whole = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    rest = F.floor("target") - whole * F.col("source_size") - F.col("begin")
    taken = F.when(
        F.col("size") > 0, whole * F.col("size") + F.least(F.greatest(rest, F.lit(0)), F.col("size"))
    ).otherwise(0)
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", "ramp", "begin", taken.cast("bigint").alias("taken"), *more
    ).withColumn("position", F.when(F.col("taken") > 0, time_of(F.col("begin"))))


def time_of(place: Column) -> Column:
    """When the word at `place` of its source's stream is read: the inverse of cumulative demand."""
    part = place / F.col("target")
    straight = 1 - F.col("ramp")
    bent = (F.sqrt(straight * straight + 4 * F.col("ramp") * part) - straight) / (2 * F.col("ramp"))
    return F.when(F.col("ramp") == 0, part).otherwise(bent)


def training_order(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """One row per reading of a document, sorted by time: doc_id, text, source, size, repeat, words, position.

    The text is whole; a reading covers its first `words` words, which is all of them but for the last document that a
    source's target reaches.
    """
    return readings(curriculum(docs, text, doc_id, source, carry=True)).drop("begin")


def readings(mix: DataFrame) -> DataFrame:
    """The rows of `curriculum` that are read, once per reading, in training order; `begin` tells them apart in a source."""
    again = F.explode(F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("size")).cast("int") - 1))
    return (
        mix.where("taken > 0").withColumn("repeat", again)
        .select(
            "doc_id", *(["text"] if "text" in mix.columns else []), "source", "begin", "size", "repeat",
            F.least("size", F.col("taken") - F.col("repeat") * F.col("size")).alias("words"),
            time_of(F.col("begin") + F.col("repeat") * F.col("source_size")).alias("position"),
        )
        .orderBy("position", "source", "doc_id", "repeat")
    )


def taken_in_order(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The columns of `curriculum`, with `taken` and `position` as the training order has them.

    The order is written reading by reading, without texts; words are added up over a document's readings, and its
    position is that of the first. Rows of a source that have words begin at different places, which tells readings apart.
    """
    mix = stored(curriculum(docs, text, doc_id, source), "mix")
    order = stored(readings(mix), "mix-order")
    name = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    read = order.groupBy(name.alias("r_key"), F.col("begin").alias("r_begin")).agg(
        F.sum("words").alias("words"), F.min("position").alias("first")
    )
    worded = mix.where("size > 0").join(read, (name == F.col("r_key")) & (F.col("begin") == F.col("r_begin")), "left")
    return worded.select(
        *[c for c in mix.columns if c not in ("taken", "position")],
        F.coalesce("words", F.lit(0)).cast("bigint").alias("taken"), F.col("first").alias("position"),
    ).unionByName(mix.where("size = 0"))
