"""The numbered queries that SQL can express, against their SQL."""

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1])]

from compare import difference, open_tables  # noqa: E402
from threadloom.llm.queries import QUERIES, SQL  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no stored tables")


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    assert difference(spark, open_tables(FOLDER), QUERIES[name], SQL[name], FOLDER) is None
