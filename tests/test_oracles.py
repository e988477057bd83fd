"""Every query with SQL gives the SQL's rows on the smallest test tables; the others give rows."""

import pytest
from compare import connect, differences

from fleetlens import catalog

SF_DIR = "/root/testdata/sf0.001"
ORACLES, QUERIES = catalog.oracles(), catalog.queries()


@pytest.fixture(scope="module")
def con():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
