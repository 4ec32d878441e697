"""Every registered query against its SQL, on the smallest test set."""

from __future__ import annotations

import os

import pytest

from tests.conftest import TESTDATA

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, difference
from workload.oracle import ORACLE
from workload.queries import QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(TESTDATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(TESTDATA)


def test_every_query_of_the_library_has_its_sql():
    assert set(QUERIES) == set(ORACLE) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert difference(spark, duck, TESTDATA, name) is None


def test_entry(spark):
    assert entry(spark).count() > 0
