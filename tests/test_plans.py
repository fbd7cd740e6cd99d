"""Physical plans: no quadratic joins, no needless columns, pruned scans."""

import re

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# the streaming queries run when they are built, and late_ticks only compares with a scalar
BATCH = sorted(n for n in entry.queries() if not n.startswith("stream_") and n not in ("landed_files", "trade_price_change_balanced"))


@pytest.mark.parametrize("name", BATCH)
def test_no_quadratic_join_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    for bad in ("NestedLoop", "CartesianProduct", "Python", "Pandas"):
        assert bad not in text


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", ["market_metrics", "asof_latest_filing", "statement_fact", "ttm_point_in_time", "upsert_prices"])
def test_large_sides_meet_in_a_sort_merge_join(spark, no_broadcast, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_asof_spreads_an_entity_over_slots(spark, no_broadcast):
    text = plan(entry.queries()["asof_latest_filing"](spark, FOLDER))
    assert re.search(r"hashpartitioning\(company_key#\d+L, _left_slot#\d+", text)


def test_flagship_reads_the_lines_twice(spark):
    text = plan(entry.queries()["market_metrics"](spark, FOLDER))
    assert text.count("FileScan") == 2


def test_scans_read_only_what_is_used(spark):
    text = plan(entry.queries()["price_gaps"](spark, FOLDER))
    scan = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    assert {c.split("#")[0] for c in scan.split(",")} == {"l_suppkey", "l_shipdate"}


def test_range_filters_reach_the_scan(spark):
    text = plan(entry.queries()["keep_latest"](spark, FOLDER).where("l_orderkey = 7"))
    assert "EqualTo(l_orderkey,7)" in text


def test_daily_metrics_need_one_shuffle_of_the_bars(spark):
    text = plan(entry.queries()["daily_equity_metrics"](spark, FOLDER))
    assert text.count("Exchange hashpartitioning") == 2  # building the bars, and the series
