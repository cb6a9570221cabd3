"""Legacy web archives (ARC) to WARC.

ARC files begin with a version block that names their version and so the fields of each record's header line; a record is
that line, as many bytes as it declares, and a line end. The converter reads both versions by declared length, gives each
record the identifier, timestamp, type and digests that WARC wants, and writes WARC records: the first of equal payloads
as a response, the others as revisits that name it.

Archives are written by Spark's text writer where the pages are, with the record end as the line separator, and read whole,
a file at a time. A file holds a fixed number of records, of `FILE_BYTES` on average; every one begins with its own version
block. Equal payloads are found by a map-side combined aggregate on digest and length; what has an equal is joined by plain
exchanges, whose hot keys adaptive execution splits, and the rest is converted where it is read.

Defined results: payloads are bytes, text or not; a null payload is empty, a null url `-`; blanks and control characters in
urls are percent-encoded; null page ids have no number and give way to those that have one; repeated rows of one page id
are all responses; pages of any length are one record each; extra columns are ignored; an empty table gives no records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.shared import quoted, sieve, sifted, stored
from tierflow.session import new_area

FILE_BYTES = 16 << 20
#: Fixed values of the formats: fields of a record's header line by ARC version; ends of records; profile of revisits.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename",
        "Archive-length"),
}
ARC_END, WARC_END = "\n", "\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
NO_IP, NO_DATE = "0.0.0.0", "19700101000000"
PAGE_HEADER, LENGTH_HEADER = "X-Page-Id", "X-Payload-Bytes"


def digest_of(payload: bytes) -> str:
    """SHA-1 in upper-case base32, as archives write it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def safe_url(url: str | None) -> str:
    """The url without blanks and control characters, which would end the field; they are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: "%%%02X" % ord(m[0]), url or "") or "-"


def records_per_file(sizes: DataFrame, size: Column) -> int:
    """How many records of average size make about `FILE_BYTES`; two at least."""
    total, count = sizes.agg(F.sum(size), F.count(F.lit(1))).first()
    return max(2, FILE_BYTES * count // total) if total else 1000


# --- ARC -------------------------------------------------------------------------------------------------------------


def arc_record(version: int, url: str | None, body: bytes, date: str, status: int, page_id: object) -> bytes:
    """Header line and network document of one record, without the line end that closes it."""
    own = "" if page_id is None else f"{PAGE_HEADER}: {page_id}\r\n"
    document = f"HTTP/1.1 {status} OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}\r\n".encode() + body
    fields = [safe_url(url), NO_IP, date, "text/html"]
    if version == 2:
        fields += [str(status), "-", "-", "0", "-"]
    return " ".join([*fields, str(len(document))]).encode() + b"\n" + document


def arc_version_block(version: int, date: str) -> bytes:
    block = f"{version} 0 tierflow\n{' '.join(ARC_FIELDS[version])}\n".encode()
    fields = ["filedesc://tierflow", NO_IP, date, "text/plain"] + (["200", "-", "-", "0", "-"] if version == 2 else [])
    return " ".join([*fields, str(len(block))]).encode() + b"\n" + block


def write_arc(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", body: str = "html") -> int:
    """ARC files of `pages`, half of them in either version; gives the number of records in each. A null body is empty."""
    rows = pages.select(
        F.col(quoted(page_id)).cast("string").alias("id"), F.col(quoted(url)).alias("url"), F.col(quoted(body)).cast("binary").alias("body")
    )

    per_file = records_per_file(rows, F.coalesce(F.octet_length("body"), F.lit(0)))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
        from pyspark import TaskContext

        version = 1 + TaskContext.get().partitionId() % 2
        written = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part, out = batch.slice(at, 64), []
                for i, u, b in zip(*(part.column(c).to_pylist() for c in ("id", "url", "body"))):
                    if written % per_file == 0:  # the writer is about to begin a file
                        out.append(arc_version_block(version, NO_DATE))
                        written += 1
                    out.append(arc_record(version, u, b or b"", NO_DATE, 200, i))
                    written += 1
                yield out

    write_records(rows, make, path, ARC_END, per_file)
    return per_file


@dataclass(frozen=True)
class Capture:
    """What an ARC record holds: `head` is the status line and headers of a response as they came, empty for other documents."""

    url: str
    ip: str
    date: str
    mime: str
    head: bytes
    payload: bytes

    @property
    def headers(self) -> dict[str, str]:
        return header_fields(self.head)


def parse_arc(data: bytes) -> Iterator[Capture]:
    """The captures of an ARC file. The version block says which fields header lines have."""
    at, names = 0, None
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError("ARC record without a header line")
        line, at = data[at:end], end + 1
        if not line.strip():
            continue
        values = line.decode("utf-8", "replace").rsplit(" ", len(names or ARC_FIELDS[1]) - 1)
        if names is None:
            # The block tells the version; its own length stands last in either version's line.
            length = int(line.rsplit(b" ", 1)[1])
            version = int(data[at : at + length].split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"ARC version {version} is not known")
            names = ARC_FIELDS[version]
            at += length + 1
            continue
        if len(values) != len(names):
            raise ValueError(f"ARC header line has {len(values)} fields, not {len(names)}")
        record = dict(zip(names, values))
        length = int(record["Archive-length"])
        document = data[at : at + length]
        if len(document) < length:
            raise ValueError("ARC record ends before its declared length")
        at += length + 1
        yield Capture(record["URL"], record["IP-address"], record["Archive-date"], record["Content-type"], *split_http(document))


def split_http(document: bytes) -> tuple[bytes, bytes]:
    """Head and body of a response; a document that is none is all body."""
    if not document.startswith(b"HTTP/"):
        return b"", document
    head, _, payload = document.partition(b"\r\n\r\n")
    return head, payload


def header_fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def read_files(spark: SparkSession, path: str, parse: Callable[[bytes], Iterator[tuple]], schema: str) -> DataFrame:
    """Rows that `parse` makes of each file below `path`, a file at a time."""
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    arrow = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(","))])

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), arrow.types)], arrow.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows: list[tuple] = []
                for row in parse(gzip.decompress(content.as_py())):
                    rows.append(row)
                    if len(rows) == 64:
                        yield table(rows)
                        rows = []
                if rows:
                    yield table(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, schema)


# --- WARC ------------------------------------------------------------------------------------------------------------


def warc_date(date: str) -> str:
    """The fourteen digits of an ARC date (missing ones are zero, first of the month) as WARC writes them."""
    digits = re.sub(r"\D", "", date)[:14]
    digits += "00000101000000"[len(digits) :]
    try:
        return datetime.strptime(digits, "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return "1970-01-01T00:00:00Z"


def record_id(url: str, date: str, page_id: object, digest: str) -> str:
    """An identifier made from what the record is, so that a task that runs again writes the same one."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join(map(str, (url, date, page_id, digest))))}>"


def warc_record(
    url: str, ip: str, date: str, mime: str, page_id: str | None, digest: str, length: int, head: bytes, payload: bytes | None,
    refers_to: dict | None = None,
) -> bytes:
    """One record without its closing line ends.

    A response keeps its status line and headers as they were captured; a document without any, such as a name lookup, is a
    resource of the type that the ARC line gives. A revisit (`refers_to` is its response's page_id, url and date) has the
    head alone.
    """
    kind = "revisit" if refers_to else "response" if head else "resource"
    block = (head + b"\r\n\r\n" if head else b"") + (b"" if refers_to else payload or b"")
    when = warc_date(date)
    lines = [
        "WARC/1.0",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(url, when, page_id, digest)}",
        f"WARC-Date: {when}",
        f"WARC-Target-URI: {url}",
        f"Content-Type: {'application/http; msgtype=response' if head else mime}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{digest_of(block)}",
        f"{LENGTH_HEADER}: {length}",
    ]
    if ip != NO_IP:
        lines.append(f"WARC-IP-Address: {ip}")
    if refers_to:
        then = warc_date(refers_to["date"])
        lines += [
            f"WARC-Profile: {SAME_PAYLOAD}",
            f"WARC-Refers-To: {record_id(refers_to['url'], then, refers_to['page_id'], digest)}",
            f"WARC-Refers-To-Target-URI: {refers_to['url']}",
            f"WARC-Refers-To-Date: {then}",
            f"X-Refers-To-Page: {refers_to['page_id']}",
        ]
    lines.append(f"Content-Length: {len(block)}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Record headers, head of the captured response and payload of each record, by declared length; block digests are verified."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        head = header_fields(data[at:end])
        length = int(head["content-length"])
        block = data[end + 4 : end + 4 + length]
        if len(block) < length or head["warc-block-digest"] != f"sha1:{digest_of(block)}":
            raise ValueError("WARC record is damaged")
        at = end + 4 + length + len(WARC_END)
        yield head, *split_http(block)


def write_records(rows: DataFrame, make: Callable[[Iterator[pa.RecordBatch]], Iterator[list[bytes]]], path: str, end: str,
                  per_file: int) -> None:
    """Lists of records as gzip files of `per_file` of them at most, each closed by `end`; records may hold any bytes.

    Archives are read once or twice and then for good by others: the fastest level of compression serves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for records in make(batches):
            # A view: the bytes are written as they are, whether they are text or not.
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary()).view(pa.string())], ["value"])

    writer = rows.mapInArrow(run, "value string").write.option("lineSep", end).option("compression", "gzip")
    writer.option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", per_file).text(path)


CAPTURES = (
    "page_id string, url string, ip string, date string, mime string, digest string, length bigint, head binary, payload binary"
)
#: What tells a record's place among those of equal payload, and what a revisit says of it.
RIVALS = "page_id string, url string, date string, digest string, length bigint, is_response boolean"


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """The captures (`CAPTURES`) in the ARC files below `path`."""

    def parse(data: bytes) -> Iterator[tuple]:
        for c in parse_arc(data):
            own = c.headers.get(PAGE_HEADER.lower())
            yield own, c.url, c.ip, c.date, c.mime, digest_of(c.payload), len(c.payload), c.head, c.payload

    return read_files(spark, path, parse, CAPTURES)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """`RIVALS` of the captures in the ARC files below `path`."""

    def parse(data: bytes) -> Iterator[tuple]:
        for c in parse_arc(data):
            own = c.headers.get(PAGE_HEADER.lower())
            yield own, c.url, c.date, digest_of(c.payload), len(c.payload), bool(c.head)

    return read_files(spark, path, parse, RIVALS)


def convert(spark: SparkSession, arc: str, warc: str, least: int = 0, per_file: int = 4000) -> None:
    """WARC files of `per_file` records at most for the ARC files below `arc`.

    Of responses with equal payloads of at least `least` bytes, the one with the smallest page number stays a response and
    the others become revisits of it; smaller ones are all responses. Page numbers that are no numbers come after numbers,
    missing ones last; rows that share the smallest are all responses. Documents that are no responses are never revisits.

    Digests and lengths are read first. Most payloads have no equal, which a bitmap of fixed size tells; they are converted
    where they are read, and only records that may have equals meet the table of smallest pages in an exchange.
    """
    number = F.col("page_id").try_cast("bigint")
    place = F.struct(F.col("page_id").isNull(), number.isNull(), number, "page_id", "url", "date")
    firsts = stored(
        read_digests(spark, arc).where((F.col("length") >= least) & F.col("is_response"))
        .groupBy(F.col("digest").alias("f_digest"), F.col("length").alias("f_length"))
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("f_digest", "f_length", F.struct("first.page_id", "first.url", "first.date").alias("first")),
        "arc-rivals",
    )
    bits = stored(sieve(firsts, F.col("f_digest")), "arc-sieve")
    rows = sifted(read_arc(spark, arc), F.col("digest"), bits, "rival")
    met = rows.where("rival").join(
        firsts.hint("merge"),
        (F.col("digest") == F.col("f_digest")) & (F.col("length") == F.col("f_length")) & (F.octet_length("head") > 0), "left",
    )
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    names = [c.split()[0] for c in CAPTURES.split(", ")]
    alone = rows.where("NOT rival").select(*names, F.lit(None).cast(met.schema["first"].dataType).alias("refers_to"))
    judged = met.select(
        *names[:-1], F.when(~again, F.col("payload")).alias("payload"), F.when(again, F.col("first")).alias("refers_to")
    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
        order = ("url", "ip", "date", "mime", "page_id", "digest", "length", "head", "payload", "refers_to")
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                yield [warc_record(*r) for r in zip(*(part.column(n).to_pylist() for n in order))]

    write_records(alone.unionByName(judged), make, warc, WARC_END, per_file)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records below `path`: page_id, record_type, url, date, payload_bytes and payload_digest (of the full payload,
    also for revisits), refers_to, head, payload (null for revisits)."""

    def parse(data: bytes) -> Iterator[tuple]:
        for head, http, payload in parse_warc(data):
            revisit = head["warc-type"] == "revisit"
            yield (
                header_fields(http).get(PAGE_HEADER.lower()), head["warc-type"], head["warc-target-uri"], head["warc-date"],
                int(head[LENGTH_HEADER.lower()]) if revisit else len(payload),
                head["warc-payload-digest"].removeprefix("sha1:") if revisit else digest_of(payload),
                head.get("x-refers-to-page"), http, None if revisit else payload,
            )

    schema = ("page_id string, record_type string, url string, date string, payload_bytes bigint, payload_digest string,"
              " refers_to string, head binary, payload binary")
    return read_files(spark, path, parse, schema)


def archive(pages: DataFrame, page_id: str = "page_id", url: str = "url", body: str = "html", least: int = 0) -> DataFrame:
    """`pages` written as ARC, converted to WARC and read back; all archives stay in the shared folder."""
    spark = pages.sparkSession
    arc, warc = new_area(spark, "arc"), new_area(spark, "warc")
    convert(spark, arc, warc, least, write_arc(pages, arc, page_id, url, body))
    return read_warc(spark, warc)
