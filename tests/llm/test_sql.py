"""Registered queries of the operators against their check SQL."""

import pytest

import compare
from codestrata.llm import queries
from conftest import SF_DIR


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    assert compare.check(spark, compare.duck(SF_DIR), SF_DIR, queries.QUERIES[name], queries.ORACLES[name]) is None
