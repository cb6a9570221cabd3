"""Exact duplicates by most-significant-byte-first radix partitioning.

Documents are split by successive runs of bytes of their normalised text: first by its first bytes, then every group
that still has more than one document by the bytes that follow, until a group is a single document or its texts have
ended. Equality is decided by the bytes themselves; no digest takes part. Runs grow fourfold from round to round, so
the number of rounds is the logarithm of the longest text that has a rival, and each round handles only the documents
that are not yet told apart.

Documents whose first bytes are nobody else's stay where they are; a bitmap of fixed size spots them before the first
shuffle. It decides no equality: a document that it lets through meets its rivals byte by byte.

Skew: a group is counted with a map-side combined aggregate, so a pile of copies costs one row per map task; documents
find their group in a sort-merge join of two plain exchanges, which adaptive execution splits at hot keys; the groups
have no size bound, so they are never broadcast. Every round
ends in a table in the shared folder, so lineage stays short and a lost executor repeats one round at most.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.shared import BLANK, quoted, row_of, sieve, sifted, stored
from tierflow.session import new_area

FIRST_RUN, GROWTH = 32, 4


def normalised(text: Column) -> Column:
    """Text without blanks, tabs and line ends; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, "")


def exact_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", columns: list[str] | None = None, digest: bool = True
) -> DataFrame:
    """One row per row of `docs`: `row` (struct of `columns`, all by default), keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised bytes are. Of equal texts the row with the most code points in the original
    text stays, then the one with the smallest id (null ids last); of rows that tie in both, exactly one has `kept`.
    Empty and null texts are equal to each other. An empty table gives an empty result. `digest` only adds the
    SHA-256 of the normalised text to the result.
    """
    spark = docs.sparkSession
    wanted = docs.columns if columns is None else columns
    source = docs.select(
        row_of(docs).alias("row"),
        F.col(quoted(doc_id)).alias("id"),
        F.col(quoted(text)).alias("text"),
    )

    # Rows that bring their text along need it once only.
    own = text in wanted
    body = F.col("row")[text] if own else F.col("text")
    apart = [] if own else ["text"]

    def unfinished(going_on: Column) -> list[Column]:
        return [F.when(going_on, F.col(c)).alias(c) for c in apart]

    def kept_columns(row: Column) -> Column:
        return F.struct(*[row[c].alias(c) for c in wanted])

    def with_run(df: DataFrame, offset: int, size: int) -> DataFrame:
        return df.withColumn("run", F.substring(normalised(body).cast("binary"), offset + 1, size))

    # Round one: the first bytes alone. Texts with no rival there are finished.
    first = with_run(source.select(kept_columns(F.col("row")).alias("row"), "id", *apart), 0, FIRST_RUN)
    rivals = stored(
        first.groupBy("run").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
            F.col("run").alias("g_run"), F.monotonically_increasing_id().alias("gid")
        ),
        "radix-groups",
    )
    sha = F.sha2(normalised(body).cast("binary"), 256) if digest else F.lit(None).cast("string")
    # Most documents differ from all others in their first bytes and need not move: a bitmap tells which surely do.
    marked = sifted(first, F.col("run"), stored(sieve(rivals, F.col("g_run")), "radix-sieve"), "rival")
    alone = marked.where("NOT rival").select(
        "row", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"),
        sha.alias("text_sha256"),
    )
    first = marked.where("rival").drop("rival")
    told = first.join(rivals.hint("merge"), first["run"] == rivals["g_run"], "left").select(
        "row",
        "id",
        sha.alias("sha"),
        F.col("gid").isNull().alias("done"),
        *unfinished(F.col("gid").isNotNull()),
        "gid",
        F.monotonically_increasing_id().alias("nr"),
        F.when(F.col("gid").isNull(), F.col("id")).alias("keep_id"),
        F.when(F.col("gid").isNull(), F.lit(1).cast("bigint")).alias("n"),
        F.col("gid").isNull().alias("kept"),
    )
    rounds = [split_table(told, new_area(spark, "radix-round"))]
    offset, size = FIRST_RUN, FIRST_RUN * GROWTH
    while True:
        active = with_run(rounds[-1].where("NOT done"), offset, size)
        if rounds[-1].where("NOT done").isEmpty():
            break
        rank = F.struct(
            (-F.char_length(F.coalesce(body, F.lit("")))).alias("shortness"),
            F.col("id").isNull().alias("unnamed"),
            F.col("id").alias("id"),
            F.col("nr").alias("nr"),
        )
        groups = stored(
            active.groupBy(F.col("gid").alias("g_gid"), F.col("run").alias("g_run"))
            .agg(F.count(F.lit(1)).alias("g_n"), F.min(rank).alias("best"))
            .select(
                "g_gid", "g_run", "g_n", "best",
                ((F.col("g_n") == 1) | (F.octet_length("g_run") < size)).alias("g_done"),
                F.monotonically_increasing_id().alias("next"),
            ),
            "radix-groups",
        )
        done = F.col("g_done")
        told = active.join(groups.hint("merge"), (active["gid"] == groups["g_gid"]) & (active["run"] == groups["g_run"])).select(
            "row",
            "id",
            "sha",
            done.alias("done"),
            *unfinished(~done),
            F.col("next").alias("gid"),
            "nr",
            F.when(done, F.col("best.id")).alias("keep_id"),
            F.when(done, F.col("g_n")).alias("n"),
            (done & (F.col("best.nr") == F.col("nr"))).alias("kept"),
        )
        rounds.append(split_table(told, new_area(spark, "radix-round")))
        offset, size = offset + size, size * GROWTH
    told_apart = (
        r.where("done").select("row", "keep_id", F.col("n").alias("group_size"), "kept", F.col("sha").alias("text_sha256"))
        for r in rounds
    )
    return reduce(DataFrame.unionAll, told_apart, alone)


def split_table(df: DataFrame, path: str) -> DataFrame:
    """Stored with finished and unfinished rows in folders of their own, so that each round reads only what it needs."""
    df.write.partitionBy("done").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of `docs` that stay, with its columns."""
    return exact_duplicates(docs, text, doc_id, digest=False).where("kept").select("row.*")
