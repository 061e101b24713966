"""Every registered query against its SQL, on the smallest data set."""

import os
import sys

import compare
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry_points  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", entry_points.entries.SPARK)
def test_query_equals_sql(spark, con, name):
    difference = compare.difference(entry_points.queries()[name](spark, SF_DIR), con, entry_points.oracle_sql()[name])
    assert not difference, difference


def test_flagship(spark):
    out = entry_points.entry(spark)
    assert len(out.columns) == 44 and out.count() == 80


def test_batches_are_read_by_directory(spark):
    plan = entry_points.queries()["scan_one_batch"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_time" in plan
