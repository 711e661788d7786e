"""Every registered query against its SQL, on the small tables."""

import __spark_entry__ as driver
import pytest
from compare import check, connect

from moodlake.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert check(QUERIES[name](spark, SF), con, ORACLES[name]) > 0


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() > 0
