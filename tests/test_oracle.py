import importlib

import pytest

from oracle import connect, oracle_result, spark_result

ENTRY = importlib.import_module("__spark_entry__")
FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


OWN = sorted(set(ENTRY.queries()) - set(ENTRY.llm_queries.QUERIES if ENTRY.llm_queries else ()) - {"pipeline"})


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(ENTRY.oracle_sql()) <= set(ENTRY.queries())


@pytest.mark.parametrize("name", OWN)
def test_matches_oracle(spark, duck, name):
    columns, rows = spark_result(ENTRY.queries()[name](spark, FOLDER))
    expected_columns, expected = oracle_result(duck, ENTRY.oracle_sql()[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
    assert rows
