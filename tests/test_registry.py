"""Every registered query against its SQL, on the smallest test tables."""

from __future__ import annotations

import pytest
from conftest import SF_DIR

import __spark_entry__ as registry
from tools.check import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registry.site_queries()) == set(registry.site_sql())


@pytest.mark.parametrize("name", list(registry.site_queries()))
def test_query_equals_sql(spark, con, name):
    equal, note = compare(spark, con, name, SF_DIR)
    assert equal, note


def test_entry(spark):
    assert registry.entry(spark).count() == 269
