"""Every registered query gives the rows of its SQL."""

import pytest

from checks import ORACLES, QUERIES
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    assert differences(spark, duck, name, QUERIES[name], ORACLES[name], sf_dir) == []


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(ORACLES)
