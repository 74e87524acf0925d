"""Physical plans that have to hold at scale."""

import re

import pytest

from linguamart.checks import QUERIES
from linguamart.checks.registry import table

SF_DIR = "/root/testdata/sf0.001"
# Queries that write tables on the way end in a scan of them; their plans show nothing.
LAZY = sorted(n for n in QUERIES if not n.startswith((
    "q_source", "q_file", "q_incremental", "q_late", "q_rerun", "q_schema_sync", "q_merge", "q_trend_incremental", "q_stream", "q_lost", "q_unique_growing", "q_ledger", "q_audited",
    "q_distinct_sketches", "q_silver_day", "q_csv_sink",
)))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text, bad


@pytest.mark.parametrize("name", ["q_staging_store", "q_silver_popularity", "q_latest_per_key_day", "q_first_in_order", "q_fct_games_daily"])
def test_dedupe_limits_rows_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert re.search(r"Exchange hashpartitioning[^\n]*\n[^\n]*WindowGroupLimit[^\n]*Partial", text)


def test_daily_fact_joins_on_the_partitioning_it_has(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["q_fct_games_daily"](spark, SF_DIR)).split("Initial Plan")[-1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text
    keyed = re.findall(r"Exchange hashpartitioning\((\w+)#\d+L?, (\w+)#\d+", text)
    assert len([k for k in keyed if k == ("appid", "snapshot_date")]) == 2


def test_day_filter_reaches_the_scan(spark, tmp_path):
    from pyspark.sql import functions as F

    from linguamart.plans import marts
    from linguamart.sources import write_days

    root = str(tmp_path / "store")
    df = spark.createDataFrame(
        [(1, 1.0, 1.0, None, True, "English", "RPG", "f", "2024-05-01")],
        "appid long, price_usd double, price_pln double, release_date date, release_date_missing boolean, "
        "languages string, genre string, file_path string, snapshot_date string",
    ).withColumn("snapshot_date", F.col("snapshot_date").cast("date"))
    write_days(df, root)
    daily = marts.store_daily(spark.read.parquet(root)).where("snapshot_date > '2024-04-30'")
    assert re.search(r"PartitionFilters: \[[^\]]*snapshot_date", plan(daily))


def test_scan_reads_only_the_columns_in_use(spark):
    text = plan(QUERIES["q_latest_per_key"](spark, SF_DIR))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp" in text and "props" not in text
    filtered = table(spark, SF_DIR, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan(filtered)
