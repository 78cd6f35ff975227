"""Every named query against its SQL text, and the driver contract."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from oracle_check import connect, differences

import __spark_entry__ as driver
from millwatch.plans import oracle, queries

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries.QUERIES, oracle.ORACLES


@pytest.fixture(scope="module")
def outcomes(spark):
    """The comparisons, several at a time, each in a session of its own."""
    duck = connect(SF)

    def compare(name):
        return differences(QUERIES[name](spark.newSession(), SF), duck.cursor(), ORACLES[name])

    with ThreadPoolExecutor(6) as pool:
        futures = {name: pool.submit(compare, name) for name in sorted(ORACLES)}
        yield futures
    duck.close()


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() == 15


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(outcomes, name):
    assert outcomes[name].result() == ""
