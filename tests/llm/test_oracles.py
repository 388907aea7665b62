"""Registered queries against their DuckDB SQL."""

import pytest

from oracle import connect, oracle_result, spark_result
from shelfwise.llm import queries

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_oracle(spark, name):
    columns, rows = spark_result(queries.QUERIES[name](spark, FOLDER))
    expected_columns, expected = oracle_result(connect(FOLDER), queries.ORACLE[name])
    assert columns == expected_columns
    assert rows == expected and rows
