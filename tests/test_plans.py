"""Plan shape: nothing in Python, no cross join, pushed filters, few scans."""

import re

import __spark_entry__ as entry
import pytest
from pyspark.sql import functions as F

from footfall.operators import skew
from footfall.plans import CATALOG
from footfall.sources import files
from footfall.sources import tables as src

QUERIES = {k: q for k, q in entry.queries().items() if k in CATALOG}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan_of(df).split("Initial Plan")[0]


BATCH = [k for k in QUERIES if not k.startswith("stream_")]


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_no_python_and_no_cross_join(spark, small, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        for key in BATCH:
            plan = plan_of(QUERIES[key](spark, small))
            for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "MapInArrow"):
                assert bad not in plan, (key, bad)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(
    "key", ["area_top3_products", "province_top3_ads", "top10_sessions_per_category", "stratified_session_extract",
            "drop_duplicates_by_key", "rowkey_dedupe", "first_seen_running_blacklist"],
)
def test_rankings_are_cut_before_the_shuffle(spark, small, key):
    assert re.search(r"WindowGroupLimit .*Partial", plan_of(QUERIES[key](spark, small)))


@pytest.mark.parametrize("key", ["page_transitions", "kpi_inbound_bounce"])
def test_ordered_rows_are_shuffled_once(spark, small, key):
    assert "ReusedExchange" in final_plan(QUERIES[key](spark, small))


@pytest.mark.parametrize(
    "key", ["kpi_active_users", "kpi_sessions", "kpi_location", "kpi_inbound", "kpi_hourly_active_users",
            "event_rollup", "order_count_cube", "view_depth_user", "category_click_order_pay", "session_aggregate"],
)
def test_one_scan(spark, small, key):
    assert plan_of(QUERIES[key](spark, small)).count("FileScan parquet") == 1


def test_time_filter_is_pushed(spark, small):
    events = files.time_range(src.table(spark, small, "events"), "2024-01-10", "2024-01-11", "ts").select("event_id")
    plan = plan_of(events)
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_date_range_reaches_the_scan(spark, small):
    plan = plan_of(QUERIES["scan_date_range"](spark, small))
    assert "GreaterThanOrEqual(ts,2024-01-10" in plan and "LessThan(ts,2024-01-21" in plan


def test_one_day_of_the_event_log(spark, small):
    plan = plan_of(QUERIES["event_log_scan"](spark, small))
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert "EqualTo(en,e_l)" in plan
    assert "p_ref" not in re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)


def read_schema(plan):
    return re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)


@pytest.mark.parametrize("key", ["kpi_sessions", "area_top3_products", "pred_epoch_day", "distinct_rows"])
def test_json_is_read_only_where_it_is_used(spark, small, key):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", plan_of(QUERIES[key](spark, small)))
    assert schemas and not any("props" in s for s in schemas)


def test_one_day_reaches_the_scan_of_the_logs(spark, small):
    plan = plan_of(QUERIES["pred_epoch_day"](spark, small))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    assert read_schema(plan) == "event_id:bigint,ts:timestamp_ntz"


def test_two_columns_are_read_for_two(spark, small):
    plan = plan_of(QUERIES["repartition_layout"](spark, small))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_broadcast_is_checked(spark):
    big, small = spark.range(10**9), spark.range(10)
    assert skew.is_small(small) and not skew.is_small(big)
    assert "broadcast" not in skew.checked_broadcast(big)._jdf.queryExecution().logical().toString()
    left = spark.range(10**9).select((F.col("id") % 7).alias("id"))
    assert "BroadcastHashJoin" in plan_of(left.join(skew.checked_broadcast(small), "id"))


def test_repeated_side_is_not_broadcast(spark, small):
    """The planner's estimate of the right side leaves its copies out."""
    plan = final_plan(QUERIES["salted_expand_join"](spark, small))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_shuffles_are_not_gathered_to_one_large_task_a_core(spark):
    """24 million rows of some 200 MB: tasks grow in number, not in size."""
    from footfall.session import apply_settings

    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        apply_settings(spark)
        ids = spark.range(24_000_000).select(F.xxhash64("id").alias("h")).groupBy("h").count()
        plan = ids.groupBy(F.spark_partition_id().alias("p")).count()
        assert plan.count() > 16
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_literal_relation_has_a_known_size(spark):
    from footfall import schemas

    frame = files.literal_relation(spark, [(1, "a")], schemas.KEY_VALUE)
    assert skew.plan_bytes(frame) < 1000
    assert files.literal_relation(spark, [], schemas.KEY_VALUE).count() == 0


def test_skewed_join_is_split_below_an_aggregation(spark, skewed):
    """``session.SETTINGS`` let adaptive execution split a hot key although the
    rows are grouped on the same key afterwards."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        lines = src.table(spark, skewed, "lineitem").repartition(16, "l_orderkey", "l_linenumber").select(
            F.col("l_partkey").alias("p_partkey"), "l_orderkey"
        )
        parts = src.table(spark, skewed, "part").select("p_partkey", "p_name")
        joined = lines.join(parts, "p_partkey").groupBy("p_partkey", "p_name").agg(F.max("l_orderkey"))
        assert "skew=true" in final_plan(joined)
    finally:
        for key in conf:
            spark.conf.unset(key)
