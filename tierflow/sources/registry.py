"""Topics: what a message of each kind looks like and how its rows are keyed and ordered."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import types as T

# Column names and types of the message envelope and of the three topics.
ENVELOPE = "key BINARY, value BINARY, topic STRING, partition BIGINT, offset BIGINT, timestamp BIGINT"
BOOKS = "book_id STRING, title STRING, author STRING, price DOUBLE, updated TIMESTAMP"
CUSTOMERS = (
    "customer_id STRING, email STRING, first_name STRING, last_name STRING, gender STRING,"
    " city STRING, country_code STRING, row_status STRING, row_time TIMESTAMP"
)
ORDERS = (
    "order_id STRING, order_timestamp TIMESTAMP, customer_id STRING, quantity BIGINT, total BIGINT,"
    " books ARRAY<STRUCT<book_id: STRING, quantity: BIGINT, subtotal: BIGINT>>"
)


@dataclass(frozen=True)
class Topic:
    """`schema` is a DDL string; `keys` + `sequence_by` order the changes; `required` may not be NULL."""

    name: str
    schema: str
    keys: tuple[str, ...]
    sequence_by: str
    scd_type: int | None = None
    required: tuple[str, ...] = ()

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromDDL(self.schema)


def registry(entries: Iterable[Mapping[str, Any]]) -> dict[str, Topic]:
    """Topics from configuration entries whose fields are those of `Topic`."""
    lists = ("keys", "required")
    return {e["name"]: Topic(**{f: tuple(v) if f in lists else v for f, v in e.items()}) for e in entries}


RETAIL = {
    t.name: t
    for t in (
        Topic("books", BOOKS, ("book_id",), "updated", scd_type=2, required=("book_id", "updated")),
        Topic("customers", CUSTOMERS, ("customer_id",), "row_time", scd_type=1, required=("customer_id", "row_time")),
        Topic("orders", ORDERS, ("order_id", "order_timestamp"), "order_timestamp",
              required=("order_id", "order_timestamp")),
    )
}
