"""Every registered query against its SQL."""

import pytest

from compare import connect, differences
from tierflow.plans import QUERIES, SQL

ROOT = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables():
    return ROOT, connect(ROOT)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_the_stated_result(spark, tables, name):
    root, con = tables
    assert name in SQL
    assert differences(QUERIES[name](spark, root), SQL[name], con) == []
