import base64
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tierflow.sources.feed import (
    land_feed, parse_all, parse_topic, raw_feed, rescued_fields, route, scan_envelopes, slice_by_file, sort_out,
)
from tierflow.plans.layers import customers_with_country
from tierflow.sources.registry import RETAIL
from tierflow.sources.tables import read_lookup

BOOK = {"book_id": "B01", "title": "t", "author": "a", "price": 49.5, "updated": "2025-10-20T17:20:33.507+00:00"}
ORDER = {"order_id": "000000003996", "order_timestamp": "2021-12-29 14:03:00", "customer_id": "C00159", "quantity": 2,
         "total": 73, "books": [{"book_id": "B09", "quantity": 1, "subtotal": 24},
                                {"book_id": "B01", "quantity": 1, "subtotal": 49}]}


def line(topic, value, offset=0, key="k"):
    encode = lambda text: base64.b64encode(text.encode()).decode()
    text = value if isinstance(value, str) else json.dumps(value)
    return json.dumps({"topic": topic, "key": encode(key), "value": encode(text), "partition": 0, "offset": offset,
                       "timestamp": 1640786580123})


@pytest.fixture
def feed(spark, area):
    lines = [
        line("books", BOOK), line("books", {**BOOK, "price": "dear"}), line("books", "{broken"),
        line("books", {}), line("orders", ORDER), line("orders", {**ORDER, "books": []}), line("films", {"id": 1}),
        line(None, BOOK), "no json at all",
    ]
    with open(f"{area}/feed_01.json", "w") as f:
        f.write("\n".join(lines))
    return raw_feed(spark, area)


def test_envelopes_decode_and_carry_lineage(feed):
    rows = feed.where("topic = 'orders'").collect()
    assert rows[0].key == "k" and json.loads(rows[0].value) == ORDER
    assert rows[0].create_ts.isoformat() == "2021-12-29T14:03:00.123000"
    assert all(r.source_file.endswith("/feed_01.json") for r in rows)
    assert feed.columns == ["topic", "key", "value", "create_ts", "source_file", "insert_ts"]


def test_topic_rows_keep_bad_fields_as_null(feed):
    books = parse_topic(feed, RETAIL["books"])
    assert [r.price for r in books.collect()] == [49.5, None, None, None]
    order = parse_topic(feed, RETAIL["orders"]).collect()[0]
    assert [(b.book_id, b.subtotal) for b in order.books] == [("B09", 24), ("B01", 49)]


def test_every_message_is_routed_or_quarantined(feed):
    known, quarantine = route(feed, RETAIL)
    assert {t: df.count() for t, df in known.items()} == {"books": 2, "customers": 0, "orders": 2}
    reasons = sorted(r.reason for r in quarantine.collect())
    assert reasons == ["no topic", "no topic", "unknown topic", "unreadable value", "unreadable value"]
    assert sum(df.count() for df in known.values()) + quarantine.count() == feed.count()
    assert sort_out(feed, RETAIL).where("reason IS NULL").count() == 4


def test_required_fields_decide_and_what_could_not_be_read_is_kept(spark, area):
    messages = [
        {**BOOK, "updated": "yesterday"}, {**BOOK, "book_id": None}, {k: v for k, v in BOOK.items() if k != "updated"},
        {**BOOK, "price": "dear", "extra": 1}, {"price": "dear"}, {**BOOK, "price": {"amount": 3}}, "[]", BOOK,
    ]
    with open(f"{area}/feed_01.json", "w") as f:
        f.write("\n".join(line("books", m, key=str(n)) for n, m in enumerate(messages)))
    rows = sort_out(raw_feed(spark, area), RETAIL).orderBy(F.col("key").cast("int")).collect()
    assert [r.reason for r in rows] == [
        "unreadable field: updated", "missing field: book_id", "missing field: updated", None, "missing field: book_id,updated",
        None, "unreadable value", None]
    assert [r.rescued for r in rows] == [
        {"updated": "yesterday"}, None, None, {"price": "dear"}, {"price": "dear"}, {"price": '{"amount":3}'}, None, None]
    assert [r.books.title for r in rows if r.reason is None] == ["t", "t", "t"]
    assert "_unread" not in rows[3].books.asDict()
    fields = rescued_fields(sort_out(raw_feed(spark, area), RETAIL)).select("key", "field", "raw", "reason").collect()
    assert sorted((r.key, r.field, r.raw, r.reason is None) for r in fields) == [
        ("0", "updated", "yesterday", False), ("3", "price", "dear", True), ("4", "price", "dear", False),
        ("5", "price", '{"amount":3}', True)]
    no_requirements = {"books": replace(RETAIL["books"], required=())}
    assert sort_out(raw_feed(spark, area), no_requirements).where("reason IS NULL").count() == 7


def test_all_topics_in_one_pass(feed):
    rows = parse_all(feed, RETAIL).where("topic IN ('books', 'orders')").collect()
    assert all(r.customers is None for r in rows)
    assert sum(r.books is not None for r in rows) == 4 and sum(r.orders is not None for r in rows) == 2


def test_a_message_is_parsed_once(feed):
    plan = sort_out(feed, RETAIL).where("reason IS NOT NULL").select("topic", "reason")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(StructField(") == len(RETAIL)


def test_landed_feed_reads_back(spark, feed, area):
    envelopes = scan_envelopes(spark, area).where("topic IS NOT NULL")
    landed = land_feed(envelopes, f"{area}/again")
    assert scan_envelopes(spark, landed).exceptAll(envelopes).isEmpty()


def test_subfolders_are_not_searched(spark, feed, area):
    before = feed.count()
    land_feed(scan_envelopes(spark, area), f"{area}/below")
    assert raw_feed(spark, area).count() == before
    assert raw_feed(spark, area, path_glob="feed_0[2-9].json").count() == 0


def test_a_file_slice_opens_only_that_file(spark, area):
    for number in (1, 2, 3):
        with open(f"{area}/feed_0{number}.json", "w") as f:
            f.write(line("books", {**BOOK, "book_id": f"B{number}"}))
    part = parse_topic(slice_by_file(raw_feed(spark, area), "feed_02.json"), RETAIL["books"])
    assert [r.book_id for r in part.collect()] == ["B2"]
    plan = part._jdf.queryExecution().executedPlan()
    scan = plan.collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 1


def test_topic_filter_reaches_the_scan(feed):
    plan = parse_topic(feed, RETAIL["books"])._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(topic,books)" in plan
    assert "partition:" not in plan and "offset:" not in plan


def test_lookup_with_and_without_a_given_schema(spark, area):
    with open(f"{area}/countries.json", "w") as f:
        f.write('{"code": "FR", "country": "France"}\n{"code": "IN", "country": "India"}\n')
    inferred, given = read_lookup(spark, area), read_lookup(spark, area, "code STRING, country STRING")
    assert sorted(inferred.collect()) == sorted(given.collect())
    people = spark.createDataFrame([("a", "FR"), ("b", "XX"), ("c", None)], "id string, country_code string")
    assert [tuple(r) for r in customers_with_country(people, given).collect()] == [("a", "France")]
