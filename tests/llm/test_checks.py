"""The queries that SQL can express, against their SQL."""

import os

import pytest

from tests.compare import differences, duck
from weekcast.llm.queries import CHECKS, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", list(CHECKS))
def test_query_matches_its_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), duck(SF), CHECKS[name]) == []


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{n}" for n in range(1, 14)]
