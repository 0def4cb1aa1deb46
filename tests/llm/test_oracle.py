"""Queries that SQL can express against their SQL."""

import pytest

from accordance.llm.oracles import ORACLES
from accordance.llm.queries import QUERIES
from tests.compare import duckdb_result, spark_result


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    columns, rows = spark_result(QUERIES[name](spark, sf_dir))
    expected_columns, expected = duckdb_result(sf_dir, ORACLES[name])
    assert columns == expected_columns
    assert sum(expected.values()) > 0
    missing, extra = expected - rows, rows - expected
    assert not missing and not extra, (list(missing.items())[:5], list(extra.items())[:5])
