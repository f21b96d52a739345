import pytest

import __spark_entry__ as entry_points
import oracle_check
from tiersmith.plans.oracle import ORACLE
from tiersmith.plans.workload import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return oracle_check.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_equals_its_sql(spark, connection, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    assert oracle_check.difference(df, connection, entry_points.oracle_sql()[name]) == ""


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
