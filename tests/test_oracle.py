"""Every registered query against its SQL on the smallest tables."""

import pytest

from workload.compare import connect, difference
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert difference(spark, duck, SF_DIR, name) is None
