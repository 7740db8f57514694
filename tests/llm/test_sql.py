"""The queries of this package that SQL can express, against DuckDB."""

import oracle
import pytest

from tiermill.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, name):
    assert oracle.compare(QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), SQL[name]) is None
