"""Every registered query against its SQL twin, and the driver's entry points."""

import pytest

import __spark_entry__ as driver
from oracle import differences, open_oracle
from tallyhouse.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    with open_oracle(SF_DIR) as opened:
        yield opened


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_agrees_with_sql(spark, connection, name):
    assert differences(spark, connection, name, driver.queries()[name], driver.oracle_sql()[name], SF_DIR) == []


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(driver.queries())


def test_entry(spark):
    counts = driver.entry(spark)
    assert counts.columns == ["ciudad", "NumTransacciones"]
    found = [row["NumTransacciones"] for row in counts.collect()]
    assert found == sorted(found, reverse=True) and sum(found) == 1500
