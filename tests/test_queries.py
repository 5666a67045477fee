"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
import oracle
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert driver.reference_queries().keys() == oracle.statements().keys()
    assert driver.reference_queries().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", driver.reference_queries())
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, name, SF_DIR) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0
