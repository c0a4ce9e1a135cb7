"""Every registered query against its SQL on the same tables."""

import pytest
from compare import connect, spark_rows, sql_rows

import __spark_entry__ as contract
from tableferry.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    wanted_columns, wanted = sql_rows(duck, SQL[name])
    assert columns == wanted_columns
    assert len(rows) == len(wanted)
    assert rows == wanted


def test_entry_finds_differences(spark):
    assert contract.entry(spark).count() > 0
