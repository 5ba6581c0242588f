"""What the plans must look like for large inputs."""

import re
from datetime import datetime

import __spark_entry__ as entry
from refinery.operators.incremental import newer_than
from refinery.operators.profile import profile_metrics
from refinery.operators.rules import summarise
from refinery.operators.skew import broadcast_join, spread_join
from refinery.queries.profiling import CONFIG, nullable_lines
from refinery.queries.rules import ORDER_RULES, RUN, orders

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    df.collect()
    return plan_of(df)


def test_rules_read_their_input_once(spark):
    plan = plan_of(summarise(orders(spark, FOLDER), ORDER_RULES, RUN))
    assert plan.count("FileScan") == 1
    assert "Generate" in plan and plan.index("Generate") < plan.index("Aggregate")


def test_failed_records_need_no_shuffle(spark):
    plan = plan_of(entry.queries()["dq_quarantine"](spark, FOLDER))
    assert "Exchange" not in plan and plan.count("FileScan") == 1


def test_latest_is_limited_before_the_shuffle(spark):
    plan = plan_of(entry.queries()["dedup_latest"](spark, FOLDER))
    assert re.search(r"Final.*Exchange hashpartitioning.*Partial", plan, re.S)


def test_cleaning_shuffles_once(spark):
    plan = plan_of(entry.queries()["structural_clean"](spark, FOLDER))
    assert plan.count("Exchange hashpartitioning") == 1


def test_mark_reaches_the_reader(spark):
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    plan = plan_of(newer_than(events, "ts", datetime(2024, 1, 1)).select("event_id"))
    assert "GreaterThan(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_profile_reads_twice_whatever_the_config(spark):
    plan = plan_of(profile_metrics(nullable_lines(spark, FOLDER), "lines", CONFIG))
    assert plan.count("FileScan") == 2


def test_top_k_does_not_sort_everything(spark):
    plan = plan_of(entry.queries()["top_k"](spark, FOLDER))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_json_is_parsed_once(spark):
    plan = plan_of(entry.queries()["parse_raw_json"](spark, FOLDER).where("k > 5 AND k < 9"))
    assert plan.count("from_json") == 1


def test_lookup_ways(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    suppliers = spark.read.parquet(f"{FOLDER}/supplier.parquet").withColumnRenamed(
        "s_suppkey", "l_suppkey"
    )
    small = plan_of(broadcast_join(lines, suppliers, "l_suppkey", "left"))
    assert "BroadcastHashJoin" in small and "Exchange hash" not in small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        large = plan_of(spread_join(lines, suppliers, "l_suppkey", "left", hot_rows=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Only the bitmap of hot keys is broadcast, once for each side; they meet by key and salt.
    assert large.count("SortMergeJoin") == 1
    assert large.count("BroadcastExchange") == 2 and "bit_or" in large
