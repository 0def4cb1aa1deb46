"""Every registered query against the same result in SQL."""

import pytest

from showcase.oracles import ORACLES
from showcase.queries import QUERIES
from tests.compare import duckdb_result, spark_result


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    columns, rows = spark_result(QUERIES[name](spark, sf_dir))
    expected_columns, expected = duckdb_result(sf_dir, ORACLES[name])
    assert columns == expected_columns
    assert sum(expected.values()) > 0
    missing, extra = expected - rows, rows - expected
    assert not missing and not extra, (list(missing.items())[:5], list(extra.items())[:5])
