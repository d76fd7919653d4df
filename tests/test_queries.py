"""Every registered query that SQL can express gives the rows of its SQL; the others give a stable schema."""

import pytest
from compare import duck, rows_of_spark, rows_of_sql

from loomchain import catalog

NAMES = sorted(catalog.oracle_sql())


@pytest.fixture(scope="module")
def connection(sf):
    return duck(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query_gives_the_rows_of_its_sql(spark, sf, connection, name):
    df = catalog.queries()[name](spark, sf)
    names, want = rows_of_sql(connection, catalog.oracle_sql()[name])
    assert sorted(df.columns) == names
    assert rows_of_spark(df) == want


def test_all_queries_have_sql():
    assert set(catalog.queries()) == set(NAMES)
