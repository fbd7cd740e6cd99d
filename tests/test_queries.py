"""Every registered query against its SQL on the smallest sample."""

import pytest

import __spark_entry__ as entry
from checks.registry import ORACLE, QUERIES
from checks.run import compare, duck

FOLDER = "/root/testdata/sf0.001"
# no row of this small sample meets their conditions
MAY_BE_EMPTY = {"audit_quality_issues"}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, con, name):
    said = compare(spark, con, name, QUERIES[name], ORACLE[name], FOLDER)
    assert said == "" or (said == "EMPTY" and name in MAY_BE_EMPTY)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
