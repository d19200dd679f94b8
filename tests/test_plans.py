"""Plan shapes that have to hold at any data size."""

import re
from collections import Counter

import pytest

import __spark_entry__ as entrypoint
import check
from workload import registry

RANKED = [
    "us_prices_daily", "us_prices_latest", "us_prices_daily_untimed", "latest_bar", "last_two_bars", "last_two_non_null",
    "dedup_by_priority", "us_financials", "keep_last_per_key", "flatten_quotes", "last_history_bar", "ca_issuers",
    "insert_if_absent", "upsert_meta", "run_outcome", "recent_runs", "ca_prices_quotes", "ca_prices_panel", "ca_prices_fallback",
]
# One-row reports, top-k reports and capped lists; everything else must stay distributed.
SINGLE_TASK = {
    "coverage_status", "coverage_status_written", "dedup_stats", "exchange_totals", "not_found_count", "us_prices_by_time", "us_prices_rejects", "row_status", "run_log", "run_log_by_time", "run_log_early_exit", "symbol_directory_totals",
    "top_multi_class_parents", "top_suffixes", "cap_by_symbol", "cap_by_position",
    "ca_prices_quotes_status", "ca_prices_panel_status", "ca_prices_fallback_landed_status", "us_financials_load",
}


@pytest.fixture
def plan(spark, sf_dir):
    """Physical plan text without adaptive execution and without broadcasts of unknown size."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)

    def text(name):
        frame = entrypoint.queries()[name](spark, sf_dir)
        return frame._jdf.queryExecution().executedPlan().toString()

    yield text
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", RANKED)
def test_rankings_are_cut_before_the_shuffle(plan, name):
    found = Counter(re.findall(r"WindowGroupLimit .*, (Partial|Final)\n", plan(name) + "\n"))
    assert found["Partial"] >= 1 and found["Partial"] == found["Final"], found


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - {"stream_gated_append"}))
def test_no_cross_join_python_or_single_task(plan, name):
    text = plan(name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert node not in text
    assert "BroadcastExchange" not in text
    if name not in SINGLE_TASK:
        assert "Exchange SinglePartition" not in text and "TakeOrderedAndProject" not in text


def test_column_pruning_and_filter_pushdown(plan):
    seen = plan("latest_seen")
    schema = re.search(r"ReadSchema: struct<(.*?)>", seen).group(1)
    assert "l_extendedprice" not in schema and "l_orderkey" not in schema
    assert "PushedFilters: [IsNotNull(c_name)" not in seen
    one_file = plan("most_recent_period")
    assert "l_extendedprice" in one_file and "l_tax" not in one_file


def test_universe_join_stays_above_the_ranking(plan):
    lines = plan("us_prices_latest").splitlines()
    semi = next(i for i, line in enumerate(lines) if "LeftSemi" in line)
    limit = next(i for i, line in enumerate(lines) if "WindowGroupLimit" in line)
    assert semi < limit  # the plan prints the root first


@pytest.mark.parametrize("name", ["us_prices_daily", "ca_financials", "us_financials", "ca_prices_fallback", "steps_not_run"])
def test_same_results_without_broadcasts(spark, sf_dir, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        good, note = check.compare(spark, check.connect(sf_dir), name, sf_dir)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert good, note


def test_bulk_scan_reads_one_partition(spark, sf_dir):
    from workload.tables import bulk_scan

    frame = bulk_scan(registry.Tables(spark, sf_dir))
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*market.*variant", text)
    assert {"landed_file", "landed_row", "market", "variant"} <= set(frame.columns)


@pytest.mark.parametrize("name,scans", [("us_financials", 3), ("coverage_status", 3), ("us_prices_daily", 3)])
def test_each_input_is_scanned_once(plan, name, scans):
    """Three statements; or prices, stored marks and the universe."""
    assert len(re.findall("FileScan parquet", plan(name))) == scans
