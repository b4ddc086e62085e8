"""Every query against its SQL, over the whole small tables."""

import __spark_entry__ as driver
import pytest
from compare import connect, difference, type_difference

from tallyworks.plans import catalogue, chain_oracles, chains, oracles

QUERIES = catalogue.catalogue() | chains.queries()
SQL = oracles.oracles() | chain_oracles.oracles()

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    frame, sql = driver.queries()[name](spark, FOLDER), driver.oracle_sql()[name]
    assert type_difference(frame, connection, sql) is None
    assert difference(frame, connection, sql) is None


def test_entry(spark):
    frame = driver.entry(spark)
    assert frame.columns == ["course", "batch", "avg_attendance", "mode_grade"]
    assert frame.count() > 0


@pytest.mark.parametrize("name", ["roster_avg_mode", "roster_pct_below", "roster_top3", "pig_pct_below", "top_words"])
def test_ordered_results(spark, connection, name):
    found = [tuple(r) for r in driver.queries()[name](spark, FOLDER).collect()]
    wanted = connection.execute(driver.oracle_sql()[name]).fetchall()
    assert [r[:2] for r in found] == [r[:2] for r in wanted]
