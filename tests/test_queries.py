"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from kerbside.plans import catalog
from oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(catalog.queries()) <= set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF_DIR), con, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 526


def test_session_time_zone_does_not_matter(spark, con):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("ward_energy_15m", "aqi_advisory", "incident_messages", "dlq_report_5m", "energy_weekly_rollup"):
            assert compare(entry.queries()[name](spark, SF_DIR), con, SQL[name]) is None, name
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
