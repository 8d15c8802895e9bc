"""What the physical plans must look like to hold at scale."""

import re

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from tidemark import Aggregation, Filter, QueryConfig, WindowSpec, run_metrics, run_query
from tidemark.config import CURRENT_TICK
from tidemark.operators import retention, tables
from tidemark.plans.seeds import METRICS, SEEDS
from tidemark.sources import bindings

FOLDER = str(TESTDATA / "sf0.001")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def scans(plan):
    return re.findall(r"FileScan parquet \[(.*?)\]", plan)


def test_a_snapshot_is_one_scan_of_three_columns_and_one_shuffle(spark):
    plan = final_plan(run_query(bindings.sensor_stream(spark, FOLDER), SEEDS["RD-SPEED-PKT"]))
    assert [re.sub(r"#\d+L?", "", s) for s in scans(plan)] == ["ts,user_id,value"]
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "partial_sum" in plan and "SortAggregate" not in plan and "Python" not in plan


def test_a_history_scans_the_stream_once(spark):
    plan = final_plan(run_query(bindings.sensor_stream(spark, FOLDER), SEEDS["RD-SPEED-PKT"], "changed"))
    assert len(scans(plan)) == 1 or "ReusedExchange" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SinglePartition" not in plan and "Python" not in plan


def test_all_dimensions_and_aggregates_share_a_scan(spark):
    plan = final_plan(run_metrics(bindings.event_stream(spark, FOLDER), METRICS["EVENT-METRICS"], "summary"))
    assert len(scans(plan)) == 1
    assert "SortAggregate" not in plan


@pytest.mark.parametrize("window", [None, WindowSpec("Sliding", 5, "seconds"), WindowSpec("Sliding", 20, "events")])
def test_window_queries_join_on_equality_only(spark, window):
    config = QueryConfig("Q", "s", (Aggregation("s", "sum", "avg_speed"),), ("road_id",))
    rows = bindings.sensor_stream(spark, FOLDER)
    plan = final_plan(run_query(rows, config, "history", window=window, merge=False, key="pkt_id"))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_a_long_time_window_needs_one_shuffle_by_group_and_block(spark):
    config = QueryConfig("Q", "s", (Aggregation("m", "max", "avg_speed"),), ("road_id",))
    rows = bindings.sensor_stream(spark, FOLDER)
    plan = final_plan(run_query(rows, config, "history", window=WindowSpec("Sliding", 10_000, "seconds"), merge=False))
    assert "__piece" not in plan
    assert len(re.findall(r"Exchange hashpartitioning\(road_id#\d+, block#\d+L?, \d+\)", plan)) == 1


@pytest.mark.parametrize("mode", ["dense", "window"])
def test_opened_rows_are_not_shuffled(spark, mode):
    rows = bindings.sensor_stream(spark, FOLDER)
    if mode == "dense":
        plan = final_plan(run_query(rows, SEEDS["RD-SPEED-PKT"], "history"))
    else:
        config = QueryConfig("Q", "s", (Aggregation("m", "max", "avg_speed"),), ("road_id",))
        plan = final_plan(run_query(rows, config, "history", window=WindowSpec("Sliding", 5, "seconds"), merge=False))
    opened = plan.index("Generate explode(slice(")
    assert "Exchange" not in plan[:opened]


def test_filters_reach_the_files(spark, tmp_path):
    bindings.sensor_stream(spark, FOLDER).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    config = QueryConfig(
        "Q", "s", (Aggregation("c", "count", "*"),), ("road_id",),
        (Filter("ts", "=", CURRENT_TICK), Filter("vehicle_count", ">", 20), Filter("intersection_id", "=", "I101")),
    )
    plan = formatted(run_query(stored, config))
    assert "GreaterThan(vehicle_count,20)" in plan and "EqualTo(intersection_id,I101)" in plan
    trimmed = formatted(retention.retained(stored, WindowSpec("Sliding", 5, "seconds"), "pkt_id"))
    assert "GreaterThanOrEqual(ts" in trimmed and "Window" not in trimmed


def test_newest_rows_use_a_bounded_top_n(spark):
    assert "TakeOrderedAndProject" in final_plan(tables.newest(bindings.command_stream(spark, FOLDER), "cmd_id"))


def test_a_hot_group_is_merged_before_the_shuffle(spark):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("road_id"),
        (F.col("id") % 7).cast("int").alias("ts"),
        F.lit(1.0).alias("avg_speed"),
    )
    config = QueryConfig(
        "Q", "s", (Aggregation("c", "count", "*"), Aggregation("s", "sum", "avg_speed")), ("road_id",),
        (Filter("ts", "=", CURRENT_TICK),),
    )
    found = {(r["road_id"], r["ts"]): r["c"] for r in run_query(rows, config, "history").collect()}
    hot = rows.where("road_id = 'hot'")
    assert found["hot", 6] == hot.count()
    assert found["hot", 0] == hot.where("ts = 0").count()
