"""Every registered query against its check SQL."""

import pytest

import __spark_entry__ as entry_point
import compare
from codestrata.catalog import all_queries
from conftest import SF_DIR

QUERIES, ORACLES = all_queries()


@pytest.fixture(scope="module")
def duck():
    return compare.duck(SF_DIR)


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert compare.check(spark, duck, SF_DIR, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["repo_id", "path", "n_dependents"]
    assert df.count() > 0
