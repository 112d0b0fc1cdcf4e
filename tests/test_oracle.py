"""Every registered query equals its DuckDB oracle on the smallest test tables.

Set PULSE_ORACLE_SF to a different test-data folder to widen the check.
"""

import os

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck

SF = os.environ.get("PULSE_ORACLE_SF", "/root/testdata/sf0.001")
KEYS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    assert compare(spark, SF, key, E.queries()[key], E.oracle_sql()[key], con, verbose=True)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["year", "county", "working_age_pop", "entity_count", "per_1000",
                          "region", "sector_label"]


@pytest.mark.parametrize("key", ["daily_window_slice", "incremental_ledger", "stream_daily_counts",
                                 "upsert_preserve", "feed_first_entries"])
def test_results_do_not_depend_on_session_time_zone(spark, con, key):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert compare(spark, SF, key, E.queries()[key], E.oracle_sql()[key], con, verbose=True)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
