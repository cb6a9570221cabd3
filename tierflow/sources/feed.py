"""The message feed: scanning, decoding, topic parsing, routing and landing of JSON-lines envelopes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.scalars import all_null, from_millis, ingest_stamp, text
from tierflow.sources.registry import ENVELOPE, Topic


def scan_envelopes(
    spark: SparkSession,
    path: str | list[str],
    schema: str = ENVELOPE,
    streaming: bool = False,
    path_glob: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Envelope rows of the files directly in `path`, under a fixed schema (sub-folders are not searched)."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.schema(schema).option("recursiveFileLookup", "false")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def normalise(envelopes: DataFrame, zone: str = "UTC") -> DataFrame:
    """Decode an envelope scan into topic, key, value, create_ts, source_file, insert_ts."""
    return envelopes.select(
        "topic",
        text(F.col("key")).alias("key"),
        text(F.col("value")).alias("value"),
        from_millis(F.col("timestamp")).alias("create_ts"),
        F.col("_metadata.file_path").alias("source_file"),
        ingest_stamp(zone).alias("insert_ts"),
    )


def raw_feed(
    spark: SparkSession,
    path: str | list[str],
    schema: str = ENVELOPE,
    streaming: bool = False,
    path_glob: str | None = None,
    files_per_batch: int | None = None,
    zone: str = "UTC",
) -> DataFrame:
    return normalise(scan_envelopes(spark, path, schema, streaming, path_glob, files_per_batch), zone)


def parse_topic(feed: DataFrame, topic: Topic, zone: str = "UTC", lineage: tuple[str, ...] = ()) -> DataFrame:
    """Payload columns of one topic plus `source_file`, a fresh `insert_ts` and any further `lineage` columns."""
    payload = F.from_json("value", topic.schema).alias("payload")
    return (
        feed.where(F.col("topic") == topic.name)
        .select(*lineage, payload, "source_file")
        .select(*lineage, "payload.*", "source_file", ingest_stamp(zone).alias("insert_ts"))
    )


#: Field of a parsed struct that holds the whole document when some field of it could not be read.
UNREAD = "_unread"


def parse_all(feed: DataFrame, registry: Mapping[str, Topic], rescue: bool = False) -> DataFrame:
    """All topics in one pass: next to the feed columns, one struct per topic, NULL on other topics' rows.

    With `rescue` the structs have one more field, `UNREAD`. `inline` keeps what is asked of the structs above the parse:
    pushed below it, a document would be parsed again.
    """
    more, options = (f", {UNREAD} STRING", {"columnNameOfCorruptRecord": UNREAD}) if rescue else ("", {})
    payloads = [
        F.when(F.col("topic") == name, F.from_json("value", topic.schema + more, options)).alias(name)
        for name, topic in registry.items()
    ]
    return feed.select(*feed.columns, F.inline(F.array(F.struct(*payloads))))


def _rescued(topic: Topic) -> Column:
    """Raw values of the fields that are in the document but could not be read, by name; NULL if all could be.

    A document is looked at a second time only if its parse failed somewhere.
    """
    payload = F.col(topic.name)
    empty = F.array_compact(F.array(*[F.when(payload[f].isNull(), F.lit(f)) for f in topic.struct.names]))
    document = F.when(payload[UNREAD].isNotNull(), F.from_json(payload[UNREAD], "map<string,string>"))
    lost = F.map_filter(document, lambda name, value: value.isNotNull() & F.array_contains(empty, name))
    return F.when(F.size(lost) > 0, lost)


def _failed(topic: Topic, unreadable: bool) -> Column:
    """Names of the required fields that are NULL, because they could not be read or because they are not there."""
    rescued = F.coalesce(F.map_keys("rescued"), F.array().cast("array<string>"))
    lost = {f: F.array_contains(rescued, f) for f in topic.required}
    return F.concat_ws(",", *[
        F.when(F.col(topic.name)[f].isNull() & (is_lost if unreadable else ~is_lost), f) for f, is_lost in lost.items()
    ])


def sort_out(feed: DataFrame, registry: Mapping[str, Topic]) -> DataFrame:
    """As `parse_all`, with the `reason` why a row cannot become a topic row (NULL for good rows) and its `rescued` fields.

    A row is good if each field that its topic requires could be read. `rescued` has the raw values of fields that are in the
    document but could not be read, required or not, so that they differ from fields that are not there.
    """
    rescued = F.coalesce(*[F.when(F.col("topic") == name, _rescued(topic)) for name, topic in registry.items()])
    rows = parse_all(feed, registry, rescue=True).withColumn("rescued", rescued)
    reason = F.when(F.col("topic").isNull(), "no topic").when(~F.col("topic").isin(*registry), "unknown topic")
    for name, topic in registry.items():
        mine = F.col("topic") == name
        empty = F.col(name).isNull() | (all_null(F.col(name), topic.struct) & F.col("rescued").isNull())
        reason = reason.when(mine & empty, "unreadable value")
        if topic.required:
            lost, absent = _failed(topic, True), _failed(topic, False)
            reason = reason.when(mine & (lost != ""), F.concat(F.lit("unreadable field: "), lost))
            reason = reason.when(mine & (absent != ""), F.concat(F.lit("missing field: "), absent))
    plain = {name: F.col(name).dropFields(UNREAD) for name in registry}
    return rows.withColumn("reason", reason).withColumns(plain)


def rescued_fields(sorted_out: DataFrame) -> DataFrame:
    """One row per field that could not be read: its message's topic, key, time, file and fate, its name and raw value."""
    return sorted_out.where("rescued IS NOT NULL").select(
        "topic", "key", "create_ts", "source_file", "reason", F.explode("rescued").alias("field", "raw")
    )


def topic_rows(sorted_out: DataFrame, topic: str, lineage: tuple[str, ...] = ()) -> DataFrame:
    """Payload columns of a topic's good rows among rows sorted out, and further `lineage` columns."""
    good = sorted_out.where((F.col("topic") == topic) & F.col("reason").isNull())
    return good.select(*lineage, f"{topic}.*", "source_file", "insert_ts")


def rejected_rows(sorted_out: DataFrame) -> DataFrame:
    return sorted_out.where(F.col("reason").isNotNull()).select(
        "topic", "key", "value", "create_ts", "source_file", "insert_ts", "reason"
    )


def route(feed: DataFrame, registry: Mapping[str, Topic]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Readable rows per known topic, and every other row with its reason.

    To write all of them, write `sort_out` once, partitioned, as `plans.layers.bronze` does.
    """
    rows = sort_out(feed, registry)
    return {name: topic_rows(rows, name, ("key", "create_ts")) for name in registry}, rejected_rows(rows)


def file_label(path: Column) -> Column:
    """Last `name.ext` component of a path; a folder written as `name.ext/part-…` counts as one file."""
    return F.regexp_extract(path, r"([^/]+\.[A-Za-z0-9]+)(?:/part-[^/]*)?$", 1)


def slice_by_file(feed: DataFrame, file_name: str) -> DataFrame:
    """Rows of one source file. The predicate is on file metadata, so other files are not opened."""
    path = F.col("source_file")
    return feed.where(path.endswith("/" + file_name) | path.contains("/" + file_name + "/part-"))


def land_feed(envelopes: DataFrame, path: str) -> str:
    """Append envelopes to a landing folder as JSON lines; BINARY fields are written as base64."""
    envelopes.write.mode("append").json(path)
    return path
