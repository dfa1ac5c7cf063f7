"""The driver contract, and a cross-section of the checked queries at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from workload import ORACLES, QUERIES
from workload.check import TABLES, compare

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "panel_dedup", "continuity_report", "exact_lags", "past_rolling", "asof_backward_fallback", "asof_nearest", "event_windows",
    "interval_join", "baseline_compare", "segment_dim_join", "html_to_text", "url_canonical", "classify_subtype", "news_build",
    "segment_risk", "alert_rules", "scenario_impact", "interleave_priority", "title_originals", "event_groups", "error_quantiles",
    "leakage_checks", "feature_alignment", "gold_build", "upsert", "stream_bronze", "stream_dead_letter",
]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries()) >= set(QUERIES)
    assert entry.entry(spark).columns == QUERIES["dashboard_summary"](spark, SF).columns


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, con, name):
    assert name in ORACLES
    status, note = compare(spark, con, SF, name)
    assert status in ("ok", "EMPTY"), note
