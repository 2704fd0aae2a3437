"""Every registered query against its SQL, on the smallest test tables."""

import os

import pytest

import __spark_entry__ as driver
from tests.compare import differences, duck
from weekcast.plans.checks import CHECKS
from weekcast.plans.registry import QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(driver.queries()) and set(CHECKS) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, connection, name):
    frame = QUERIES[name](spark, SF_DIR)
    assert differences(frame, connection, CHECKS[name]) == []


def test_entry_has_rows_and_the_mart_schema(spark):
    df = driver.entry(spark)
    assert df.columns[:6] == ["regionseg", "regionseg3", "salesid", "productgroup", "item", "yearweek"]
    assert df.filter("yearweek > '200144'").count() > 0


def test_comparison_notices_differences(spark, connection):
    same = spark.sql("SELECT 1 AS a, CAST(0.5 AS DOUBLE) AS b")
    assert differences(same, connection, "SELECT 1 AS a, 0.5::DOUBLE AS b") == []
    assert differences(same, connection, "SELECT 1 AS a, 0.50000001::DOUBLE AS b")
    assert differences(same, connection, "SELECT 1::BIGINT AS a, 0.5::DOUBLE AS b")
    assert differences(same, connection, "SELECT 1 AS a, 0.5::DOUBLE AS c")
    assert differences(same, connection, "SELECT 1 AS a, 0.5::DOUBLE AS b FROM range(2)")
