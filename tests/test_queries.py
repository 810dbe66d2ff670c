import compare
import pytest

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"
ORACLES = driver.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", driver.queries())
def test_query(spark, connection, name):
    columns, rows = compare.spark_rows(driver.queries()[name](spark, FOLDER))
    if name in ORACLES:
        assert (columns, rows) == compare.sql_rows(connection, ORACLES[name])
    else:
        assert rows


def test_entry(spark):
    counts = {row.tag: row.n_tokens for row in driver.entry(spark).collect()}
    assert counts == {
        "O": 245, "S-Attribute": 200, "S-Brand": 143, "B-Brand": 15, "I-Brand": 15, "E-Brand": 15,
        "S-ProductType": 160, "B-ProductType": 7, "E-ProductType": 7,
    }
