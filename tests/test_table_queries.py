"""Every query over the supplied tables against DuckDB."""

import oracle
import pytest

import __spark_entry__ as entry_module

from tiermill.plans.table_queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_expected_rows():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert oracle.compare(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["n_name", "report_year", "kpiname", "kpivalue", "companycd"]
    assert df.count() > 0
