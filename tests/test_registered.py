"""Every registered query against its SQL, on whole tables."""

import re

import __spark_entry__ as registered
import pytest
from compare import duck, duck_rows, spark_rows

SF = "/root/testdata/sf0.01"
QUERIES, SQL = registered.queries(), registered.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


OPTIONAL = re.compile(r"pipeline$|op\d+_")  # the operators for training data have their own tests


def test_every_query_has_sql():
    assert {n for n in QUERIES if not OPTIONAL.match(n)} == {n for n in SQL if not OPTIONAL.match(n)}


def test_entry_is_stable(spark):
    df = registered.entry(spark)
    assert df.columns == [
        "device_id", "timestamp", "temperature", "avg_temp", "stddev_temp", "anomaly_type"
    ]
    assert df.count() > 0


@pytest.mark.parametrize("name", [n for n in QUERIES if not OPTIONAL.match(n)])
def test_query_matches_sql(spark, con, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF))
    expected_columns, expected = duck_rows(con, SQL[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected
