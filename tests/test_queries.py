"""Every registered query against its SQL on the smallest stored tables."""

from pathlib import Path

import pytest

from compare import difference, open_tables
from threadloom.plans.catalog import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no stored tables")


@pytest.fixture(scope="module")
def con():
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, con, name):
    assert difference(spark, con, QUERIES[name], SQL[name], FOLDER) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
