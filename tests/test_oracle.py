"""Every registered query with oracle SQL equals DuckDB on the same parquet tables."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_check import compare, duck

SQL = entry.oracle_sql()
SLOW = {"stream_ingest", "stream_score_sink", "stream_batch_kpis", "stream_rate"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    assert compare(df, SQL[name], con) == []


def test_every_query_has_a_callable():
    qs = entry.queries()
    assert set(SQL) <= set(qs)
    assert len(qs) >= 55


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"batch_day", "n", "n_fraud", "n_high_risk", "approval_rate"} <= set(df.columns)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_rows_only_queries_run(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    assert df.count() >= 1


TIME_KEYS = ["rate_5m", "rate_1m", "rate_summary", "running_totals", "batch_kpis", "counter_increase",
             "gauge_from_deltas", "approval_rate_series", "threshold_bands", "trailing_range", "last_not_null",
             "scan_transactions", "event_timestamp", "entity_key", "stream_rate", "publish_json"]


def test_time_queries_do_not_depend_on_session_zone(spark, con):
    """The driver may run the queries in a session whose zone is not UTC."""
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        problems = {k: compare(entry.queries()[k](spark, SF_SMALL), SQL[k], con) for k in TIME_KEYS}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {k: p for k, p in problems.items() if p} == {}
