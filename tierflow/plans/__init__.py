from tierflow.plans import dimension_queries, feed_queries, stream_queries, table_queries  # noqa: F401
from tierflow.plans.catalog import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
