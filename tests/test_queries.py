"""Every registered query against its SQL, at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry_points
from abasto.workload.compare import compare, duck
from abasto.workload.registry import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    result = compare(spark, connection, FOLDER, name)
    assert result["ok"], result["note"]
    assert not result["note"] or result["note"] == "rows only"


def test_entry_points(spark):
    assert entry_points.entry(spark).count() > 0
    assert set(entry_points.oracle_sql()) < set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.queries())
    without = set(QUERIES) - set(entry_points.oracle_sql())
    assert without == {"fc_autoregressive", "fc_price_forest"}
