"""Every registered query against its DuckDB text on the smallest tables."""

import os

import pytest
from gate import compare, connect

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_matches_duckdb(spark, duck, name):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        ok, note = compare(spark, duck, name, entry.queries()[name], entry.oracle_sql()[name], SF_DIR)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert ok, note


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
