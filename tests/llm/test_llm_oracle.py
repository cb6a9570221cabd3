"""Every text query that SQL can state, against its SQL."""

import pytest

from compare import connect, differences
from tierflow.llm.queries import QUERIES, SQL

ROOT = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_gives_the_stated_result(spark, name):
    assert differences(QUERIES[name](spark, ROOT), SQL[name], connect(ROOT)) == []
