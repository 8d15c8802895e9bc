import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark import Aggregation, ConfigError, Filter, QueryConfig, run_metrics, run_query, run_sql
from tidemark.config import CURRENT_TICK
from tidemark.functions import values
from tidemark.functions.formulas import formula_column
from tidemark.operators import series
from tidemark.plans.seeds import METRICS, SEEDS
from tidemark.sources import history

NOW = Filter("ts", "=", CURRENT_TICK)
CONFIG = QueryConfig(
    "SENSOR-METRICS", "sensor_stream",
    (Aggregation("a", "avg", "speed"), Aggregation("m", "max", "vehicle_count")),
    ("road_id", "intersection_id"), (NOW,), dimension_fields=("road_id", "intersection_id"),
)
COLUMNS = ("ts", "field", "field_value", "metric", "aggregate", "value")


def test_only_values_present_in_the_tick_are_listed(sensor):
    rows = sensor(("R1", 1, 10.0, 3), ("R2", 1, 20.0, 9), ("R1", 2, 40.0, 2))
    found = [r for r in rows_of(run_metrics(rows, CONFIG), *COLUMNS) if r[0] == 2]
    assert found == [
        (2, "intersection_id", "I101", "speed", "avg", 70.0 / 3),
        (2, "intersection_id", "I101", "vehicle_count", "max", 9.0),
        (2, "road_id", "R1", "speed", "avg", 25.0),
        (2, "road_id", "R1", "vehicle_count", "max", 3.0),
    ]


def test_a_due_tick_without_rows_lists_everything(spark, sensor):
    rows = sensor(("R1", 2, 10.0), ("R2", 5, 20.0))
    ticks = spark.createDataFrame([(t,) for t in (1, 2, 3, 4, 5, 6)], "ts int")
    found = run_metrics(rows, CONFIG, clock=ticks).where("metric = 'speed' and field = 'road_id'")
    assert rows_of(found, "ts", "field_value", "value") == [
        (2, "R1", 10.0), (3, "R1", 10.0), (4, "R1", 10.0), (5, "R2", 20.0), (6, "R1", 10.0), (6, "R2", 20.0),
    ]


def test_skipped_ticks_do_not_count(sensor):
    rows = sensor(("R1", 1, 10.0), ("R1", 2, 99.0), ("R1", 3, 20.0))
    found = run_metrics(rows, CONFIG, frequency=2).where("metric = 'speed' and field = 'road_id'")
    assert rows_of(found, "ts", "value") == [(1, 10.0), (3, 15.0)]
    summary = run_metrics(rows, CONFIG, "summary", frequency=2).where("metric_field = 'speed'")
    assert {r["helper_count"] for r in summary.collect()} == {2.0}


def test_text_values_count_as_zero_and_streams_without_dimensions_give_nothing(spark):
    events = spark.createDataFrame(
        [("e1", "Accident", "R1", "I1", 2, 1)],
        "event_id string, event_type string, road_id string, intersection_id string, priority int, ts int",
    )
    config = QueryConfig("Q", "event_stream", (Aggregation("x", "max", "event_type"),), (), (NOW,))
    assert {r["value"] for r in run_metrics(events, config).collect()} == {0.0}
    commands = spark.createDataFrame([("c1", "S1", 5, 1)], "cmd_id string, signal_id string, duration int, ts int")
    none = QueryConfig("Q", "command_stream", (Aggregation("x", "max", "duration"),), (), (NOW,))
    assert run_metrics(commands, none).count() == 0


def test_summary_key_text(sensor):
    summary = run_metrics(sensor(('R"1', 1, 10.0)), METRICS["SENSOR-METRICS"], "summary")
    assert rows_of(summary, "dimensions", "last_updated_tick")[1] == ('{"field":"road_id","field_value":"R\\"1"}', 1)


def stored(spark, *results, query_id="Q"):
    return spark.createDataFrame(
        [(i, query_id, ts, text) for i, (ts, text) in enumerate(results)],
        "id long, query_id string, ts long, result string",
    )


def test_wide_series_reads_only_numbers(spark):
    rows = stored(
        spark,
        (1, '[{"r":"A","v":1},{"r":"B","v":2.5},{"r":"A","v":true},{"r":"A","v":"x"},{"r":"A","v":"4"},{"r":"A"}]'),
        (2, '{"r":"A","v":7}'),
        (3, "not json"),
        (4, '[{"r":"A","v":8}, 5, "text", null, [1]]'),
    )
    points = series.wide_series(rows, "Q", "v", "r", "A")
    assert rows_of(points, "ts", "value") == [(1, 1.0), (1, 4.0), (2, 7.0), (4, 8.0)]
    assert rows_of(series.field_names(rows, "Q"), "field") == [("r",), ("v",)]
    assert rows_of(series.wide_series(rows, "Q", "v", "r", "A", window=2), "ts") == [(2,), (4,)]
    assert series.wide_series(rows, "other", "v").count() == 0
    assert [len(r["result"]) for r in history.parsed_history(rows).collect()] == [6, 1, 0, 1]


def test_long_series_is_distinct_and_alias_aware(spark):
    item = '{"field":"road_id","field_value":"R1","metric":"avg_speed","aggregate":"avg","value":%s}'
    old = '{"road_id":"R1","metric_field":"speed","aggregate":"avg","value":9}'
    rows = series.long_rows(stored(spark, (1, f"[{item % 1},{item % 1}]"), (5, f"[{item % 2}]"), (9, f"[{old}]")))
    for name in ("speed", "avg_speed"):
        points = series.long_series(rows, "road_id", name, "avg", "R1")
        assert rows_of(points, "ts", "value") == [(1, 1.0), (5, 2.0), (9, 9.0)]
    assert rows_of(series.long_series(rows, "road_id", "speed", "avg", "R1", window=4), "ts") == [(5,), (9,)]
    assert rows_of(series.available(rows), "field", "field_value", "metric", "aggregate") == [
        ("road_id", "R1", "speed", "avg")]


def test_json_history_round_trip(spark, sensor, tmp_path):
    rows = sensor(*((f"R{i}", t, float(i) / 2) for i in range(10) for t in (1, 2)), ('R"q\\', 2, None))
    found = run_query(rows, SEEDS["RD-SPEED-PKT"], "history")
    text = history.json_history(found, "RD-SPEED-PKT", ["road_id", "intersection_id"])
    assert text.groupBy("ts").count().agg(F.max("count")).first()[0] == 1
    for _ in range(2):
        history.append_history(text, str(tmp_path / "h"), "RD-SPEED-PKT", 3)
    back = series.exploded(history.read_history(spark, str(tmp_path / "h")))
    got = back.select("ts", "item.road_id", "item.s_spd", "item.n_spd")
    assert got.count() == found.count() == 21
    assert ("2", 'R"q\\', "0", None) in {(str(r[0]), *r[1:]) for r in got.collect()}
    assert ("1", "R3", "1.5", "1.5") in {(str(r[0]), *r[1:]) for r in got.collect()}
    assert series.latest_result(text).select("ts").distinct().collect()[0][0] == 2


def test_numbers_keep_their_digits_in_json(spark):
    rows = spark.sql("SELECT 1 AS ts, 9007199254740993L AS b, CAST(12.50 AS DECIMAL(10,2)) AS d, CAST(100 AS DECIMAL(10,2)) AS w, "
                     "CAST(700 AS DECIMAL(5,0)) AS z, 2.0D AS f, CAST(NULL AS INT) AS n")
    text = history.json_history(rows, "Q", []).first()["result"]
    assert text == '[{"b":9007199254740993,"d":12.5,"w":100,"z":700,"f":2,"n":null}]'


def test_typed_results_are_replaced_by_batch(spark, tmp_path):
    path = str(tmp_path / "r")
    for batch, ticks in ((0, [1, 2]), (1, [3]), (1, [3, 4])):
        rows = spark.createDataFrame([(t, "A", float(t)) for t in ticks], "ts long, road_id string, v double")
        for query in ("Q", "other"):
            history.append_results(rows, path, query, batch)
    assert rows_of(history.read_results(spark, path, "Q"), "ts", "v") == [(1, 1.0), (2, 2.0), (3, 3.0), (4, 4.0)]
    assert rows_of(history.newest_result(spark, path, "Q"), "ts", "road_id") == [(4, "A")]


def test_a_repeated_batch_without_rows_removes_its_own(spark, tmp_path):
    path = str(tmp_path / "r")
    rows = spark.createDataFrame([(t, "A", float(t)) for t in (1, 2, 5000)], "ts int, road_id string, v double")
    history.append_results(rows.where("ts < 3"), path, "Q", 0)
    history.append_results(rows.where("ts > 3"), path, "Q", 1)
    assert rows_of(history.newest_result(spark, path, "Q"), "ts") == [(5000,)]
    history.append_results(rows.where("ts > 9999"), path, "Q", 1)
    assert rows_of(history.read_results(spark, path, "Q"), "ts") == [(1,), (2,)]
    assert rows_of(history.newest_result(spark, path, "Q"), "ts") == [(2,)]
    history.append_results(rows.where("ts > 9999"), path, "Q", 0)
    assert history.read_results(spark, path, "Q").collect() == history.newest_result(spark, path, "Q").collect() == []
    text = history.json_history(rows, "J", ["road_id"])
    for kept in (text, text.where("ts < 0")):
        history.append_history(kept, path + "j", "J", 3)
    assert history.read_history(spark, path + "j").collect() == []


def test_an_attempt_without_a_commit_is_not_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "r")
    rows = spark.createDataFrame([(1, 1.0)], "ts int, v double")
    history.append_results(rows, path, "Q", 0)
    rows.withColumn("tick_bucket", F.lit(0)).write.partitionBy("tick_bucket").parquet(f"{path}/rows/query_id=Q/attempt=a-lost")
    assert history.read_results(spark, path, "Q").count() == 1


def test_the_last_ticks_read_only_their_folders(spark, tmp_path):
    path = str(tmp_path / "r")
    rows = spark.range(5000).select(F.col("id").alias("ts"), F.lit(1.0).alias("v"))
    history.append_results(rows, path, "Q", 0)
    last = history.read_results(spark, path, "Q", 60)
    assert rows_of(last.agg(F.min("ts"), F.max("ts"), F.count("*")), "min(ts)", "max(ts)", "count(1)") == [(4939, 4999, 61)]
    assert len({f for f in last.inputFiles() if "tick_bucket=4" in f}) >= 1
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tick_bucket" in plan and "tick_bucket#" in plan


def test_formulas(spark):
    df = spark.createDataFrame([(6.0, 2.0, 0.0)], "a double, b double, z double")
    cases = {"a / b": 3.0, "a/z": None, "a / (b - b)": None, "-a + b * 2": -2.0, "(a - b) / b / 2": 1.0, "1.5e1": 15.0, "a / b / z": None}
    got = df.select(*(formula_column(t, df.columns).alias(f"c{i}") for i, t in enumerate(cases))).first()
    assert list(got) == list(cases.values())
    for bad in ("", "a b", "a +", "(a", "a)", "greatest(a, 1)", "q", "a; b", "a ** b"):
        with pytest.raises(ConfigError):
            formula_column(bad, df.columns)


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("3",), ("x",), (None,), (" 2.5 ",)], "t string")
    assert [r[0] for r in df.select(values.number_or(F.col("t"), -1)).collect()] == [3.0, -1.0, -1.0, 2.5]
    numbers = spark.createDataFrame([(3.0,), (2.5,), (-4.0,), (None,)], "v double")
    assert [r[0] for r in numbers.select(values.whole_number_text(F.col("v"))).collect()] == ["3", "2.5", "-4", None]
    assert values.display_name("sensor_stream", "avg_speed") == "speed"
    assert values.storage_field("event_stream", "speed") == "speed"


def test_sql_text_leaves_the_views_of_the_session(spark, sensor):
    spark.range(3).createOrReplaceTempView("sensor_stream")
    found = run_sql(spark, "SELECT '{CURRENT_TICK} ''x' AS t, count(*) AS n FROM sensor_stream WHERE ts < {CURRENT_TICK}", 2,
                    {"sensor_stream": sensor(("A", 1, 1.0))})
    assert tuple(found.first()) == ("2 'x", 1)
    assert spark.table("sensor_stream").count() == 3
    spark.catalog.dropTempView("sensor_stream")


def test_sql_text_with_a_bound_tick(spark, sensor):
    rows = sensor(("A", 1, 1.0), ("A", 2, 5.0))
    found = run_sql(spark, "SELECT sum(avg_speed) s FROM sensor_stream WHERE ts = {CURRENT_TICK}", 2,
                    {"sensor_stream": rows})
    assert found.first()["s"] == 5.0
