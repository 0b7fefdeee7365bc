"""Every registered query gives the rows of its check SQL."""

import pytest

from almanac.queries import ORACLES, QUERIES
from check import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_check_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(spark, con, name, SF_DIR) is None
