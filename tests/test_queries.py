"""Every registered query against its SQL twin on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__
from wxlake.checks.compare import connect, differences

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no tables")
QUERIES, ORACLES = __spark_entry__.queries(), __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert differences(spark, duck, QUERIES[name], ORACLES[name], SF) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_twin_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    found = __spark_entry__.entry(spark)
    assert found.count() > 0 and "gloom_rank" in found.columns
