"""Every text query that has a SQL twin, against it, on the smallest tables."""

import pytest

from compare import difference, duck
from tidewell.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_result_as_sql(spark, name):
    assert difference(spark, duck(SF_DIR), name, queries.QUERIES[name], queries.ORACLES[name], SF_DIR) is None
