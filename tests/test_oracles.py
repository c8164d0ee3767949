"""Every registered query equals its SQL on the smallest tables."""

import pytest
from compare import connect, difference

from testbed.catalog import QUERIES
from testbed.oracles import ORACLES as SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck, SQL[name]) == ""
