"""Every registered query against its SQL."""

import os

import pytest

from tests.compare import connect, duck_rows, spark_rows
from tidemark.plans.catalog import QUERIES, SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    assert dict(result.dtypes).keys() == set(result.columns)
    columns, rows = spark_rows(result)
    wanted_columns, wanted = duck_rows(duck, SQL[name])
    assert columns == wanted_columns
    assert len(rows) == len(wanted) > 0
    assert rows == wanted
