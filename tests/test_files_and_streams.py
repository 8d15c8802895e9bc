"""Record files and streams: rejection, first-wins, and equality with the batch result."""

import os
import time
from functools import reduce

import pytest
from conftest import rows_of
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import Aggregation, ConfigError, Filter, QueryConfig, WindowSpec, run_metrics, run_query
from tidemark.config import CURRENT_TICK
from tidemark.plans.seeds import METRICS, SEEDS
from tidemark.sources import history, xml
from tidemark.sources.schemas import SENSOR, SUMMARY
from tidemark.streaming import live, stages
from tidemark.workload import live as workload

RECORD = (
    "<sensor_event><pkt_id>{}</pkt_id><intersection_id>I101</intersection_id><road_id>{}</road_id>"
    "<signal_id>S</signal_id><vehicle_count>{}</vehicle_count><avg_speed>{}</avg_speed>"
    "<occupancy>1.5</occupancy><ts>{}</ts></sensor_event>"
)
SPEED = SEEDS["RD-SPEED-PKT"]


def put(folder, name, *records, end="</SensorStreamInput>"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text('<?xml version="1.0"?>\n<SensorStreamInput>\n' + "\n".join(records) + end)
    time.sleep(0.02)


@pytest.fixture
def inbox(tmp_path):
    box = tmp_path / "inbox"
    put(box, "f1.xml", RECORD.format("p1", "R1", 5, 10.0, 1), RECORD.format("p2", "R2", 5, 20.0, 1))
    put(box, "f2.xml", RECORD.format("p3", "R1", "x", 10.0, 1), RECORD.format("p9", "R1", 5, 10.0, 1))
    put(box, "f3.xml", RECORD.format("p1", "R1", 5, 99.0, 2), RECORD.format("p4", "R1", 5, 60.0, 2))
    put(box, "f4.xml")
    put(box, "f5.xml", RECORD.format("p5", "R2", 1, 7.0, 1))
    put(box, "f6.xml", RECORD.format("", "R2", 1, 7.0, 1), RECORD.format("p7", "R2", 1, 7.0, 1))
    put(box, "f7.xml", RECORD.format("p8", "R2", 1, 7.0, 1), "<sensor_event><pkt_id>p10</pkt_id>", end="")
    swapped = RECORD.format("p11", "R2", 1, 7.0, 1).replace("<pkt_id>p11</pkt_id>", "")
    put(box, "f8.xml", swapped.replace("<ts>", "<pkt_id>p11</pkt_id><ts>"))
    put(box, "f9.xml", RECORD.format("p9", "R3", 1, 5.0, 2))
    return box


KEPT = [("p1", 10.0), ("p2", 20.0), ("p4", 60.0), ("p5", 7.0), ("p9", 5.0)]


def test_one_bad_record_rejects_its_file_only(spark, inbox):
    rows = xml.ingest(spark, SENSOR, str(inbox))
    assert rows.schema == SENSOR.schema
    assert rows_of(rows, "pkt_id", "avg_speed") == KEPT
    refused = {r["file_path"][-6:-4]: r["_fault"] for r in xml.quarantine(spark, SENSOR, str(inbox)).collect()
               if r["_fault"]}
    assert refused == {"f2": "invalid record", "f6": "no key", "f7": "invalid record", "f8": "invalid record"}


@pytest.fixture
def copies(tmp_path):
    box = tmp_path / "copies"
    good, bad = RECORD.format("p1", "R1", 5, 10.0, 1), RECORD.format("p2", "R1", "x", 10.0, 1)
    put(box, "a1.xml", good)
    put(box, "a2.xml", good)
    put(box, "b1.xml", bad)
    put(box, "b2.xml", bad)
    put(box, "c1.xml", good, RECORD.format("p3", "R1", 5, 30.0, 2))
    put(box, "c2.xml", good, good)
    put(box, "c3.xml", good)
    return box


def test_files_of_one_content_count_once(spark, copies):
    assert rows_of(xml.ingest(spark, SENSOR, str(copies)), "pkt_id", "avg_speed") == [("p1", 10.0), ("p3", 30.0)]
    assert [r["file_path"][-6:] for r in xml.quarantine(spark, SENSOR, str(copies)).collect()] == ["b1.xml"]
    states = xml.file_states(xml.read_records(spark, SENSOR, str(copies)), SENSOR)
    assert sorted(r["file_path"][-6:] for r in xml.fresh_files(states).collect()) == ["a1.xml", "b1.xml", "c1.xml", "c2.xml"]
    none = xml.read_records(spark, SENSOR, str(copies)).limit(0)
    assert xml.file_states(none, SENSOR).collect() == []


@pytest.mark.parametrize("per_trigger", [4, None])
def test_files_of_one_content_count_once_live(spark, copies, tmp_path, per_trigger):
    out = str(tmp_path / "out")

    def run():
        stages.start_cleaning(spark, SENSOR, str(copies), out, f"{out}/c1", per_trigger).awaitTermination()

    run()
    put(copies, "d1.xml", RECORD.format("p1", "R1", 5, 10.0, 1))
    put(copies, "d2.xml", RECORD.format("p2", "R1", "x", 10.0, 1))
    run()
    taken = spark.read.parquet(f"{out}/payloads")
    assert sorted(r["file_path"][-6:] for r in taken.collect()) == ["a1.xml", "b1.xml", "c1.xml", "c2.xml"]
    refused = spark.read.parquet(f"{out}/quarantine")
    assert [r["file_path"][-6:] for r in refused.collect()] == ["b1.xml"]
    stages.start_parts(
        spark, stages.read_clean(spark, SENSOR, out), "pkt_id", [SPEED], out, f"{out}/c2", keep_rows=True
    ).awaitTermination()
    assert rows_of(spark.read.parquet(f"{out}/rows"), "pkt_id", "avg_speed") == [("p1", 10.0), ("p3", 30.0)]
    assert rows_of(stages.read_counts(spark, out), "ts", "n") == [(1, 1), (2, 1)]


@pytest.mark.parametrize("per_trigger", [1, None])
def test_live_history_equals_the_batch_history(spark, inbox, tmp_path, per_trigger):
    out = str(tmp_path / "out")

    def run():
        stages.start_cleaning(spark, SENSOR, str(inbox), out, f"{out}/c1", per_trigger).awaitTermination()
        stages.start_parts(
            spark, stages.read_clean(spark, SENSOR, out), "pkt_id", [SPEED], out, f"{out}/c2", keep_rows=True
        ).awaitTermination()

    run()
    want = run_query(xml.ingest(spark, SENSOR, str(inbox)), SPEED, "history")
    columns = want.columns
    assert rows_of(stages.live_history(spark, out, SPEED), *columns) == rows_of(want, *columns)
    # a late row, a repeated key, and a restart from the checkpoint
    put(inbox, "g1.xml", RECORD.format("p20", "R9", 1, 3.0, 1), RECORD.format("p2", "R2", 1, 500.0, 3))
    run()
    run()
    rows = spark.read.parquet(f"{out}/rows")
    assert rows_of(rows, "pkt_id", "avg_speed") == sorted([*KEPT, ("p20", 3.0)])
    want = run_query(xml.ingest(spark, SENSOR, str(inbox)), SPEED, "history")
    assert rows_of(stages.live_history(spark, out, SPEED), *columns) == rows_of(want, *columns)
    stages.compact_parts(spark, out, SPEED, f"{out}/compact")
    assert rows_of(stages.live_history(spark, f"{out}/compact", SPEED, "snapshot"), "road_id", "c_pkt") == [
        ("R1", 2), ("R2", 2), ("R3", 1), ("R9", 1)]


def arriving(spark, sensor, tmp_path, *batches):
    path = str(tmp_path / "arriving")
    frames = [sensor(*rows) for rows in batches]
    for i, frame in enumerate(frames):
        frame.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(path), frames


def test_a_horizon_bounds_state_and_counts_late_rows(spark, sensor, tmp_path):
    rows, _ = arriving(spark, sensor, tmp_path, [("A", 0, 1.0), ("A", 500, 2.0)], [("A", 500, 9.0)], [("A", 3, 4.0)])
    out = str(tmp_path / "out")
    query = stages.start_parts(spark, rows, "pkt_id", [SPEED], out, f"{out}/c", horizon="100 seconds")
    query.awaitTermination()
    for _ in range(50):  # the counts of a batch come with its progress
        if os.path.exists(f"{out}/late") and stages.dropped_late(spark, out):
            break
        time.sleep(0.2)
    assert stages.dropped_late(spark, out) >= 1
    newest = stages.live_history(spark, out, SPEED, "snapshot")
    assert rows_of(newest, "c_pkt", "sum_speed") == [(2, 3.0)]


def test_live_snapshot_lists_all_groups(spark, sensor, tmp_path):
    config = QueryConfig(
        "Q", "sensor_stream",
        (Aggregation("s", "sum", "avg_speed"), Aggregation("v", "none", "avg_speed")),
        ("road_id",), (Filter("ts", "=", CURRENT_TICK),),
    )
    rows, frames = arriving(spark, sensor, tmp_path, [("A", 1, 1.0), ("B", 1, 2.0)], [("A", 2, 5.0)])
    query = live.live_snapshot(rows, config).writeStream.outputMode("complete").format("memory").queryName(
        "snap").trigger(availableNow=True).start()
    query.awaitTermination()
    want = run_query(frames[0].unionByName(frames[1]), config)
    assert rows_of(spark.table("snap"), *want.columns) == rows_of(want, *want.columns)


def test_live_windows_close(spark, sensor, tmp_path):
    config = QueryConfig("Q", "sensor_stream", (Aggregation("c", "count", "*"),), ("road_id",))
    rows, _ = arriving(spark, sensor, tmp_path, [("A", -100, 1.0)], [("A", -50, 1.0), ("A", 1, 1.0), ("A", 4, 1.0)], [("A", 25, 1.0)], [("A", 47, 1.0)])
    query = live.live_windows(rows, config, WindowSpec("Tumbling", 10, "seconds"), "0 seconds").writeStream.outputMode(
        "append").format("memory").queryName("wins").trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows_of(spark.table("wins"), "window_start", "c") == sorted([(-100, 1), (-50, 1), (0, 2), (20, 1)], key=str)


def test_live_forms_refuse_what_they_cannot_tell(spark, sensor):
    unpinned = QueryConfig("Q", "sensor_stream", (Aggregation("c", "count", "*"),), ("road_id",))
    with pytest.raises(ConfigError):
        live.live_snapshot(sensor(("A", 1, 1.0)), unpinned)


@pytest.mark.parametrize("options", [{"frequency": 3}, {"skip_tick_zero": True}, {"frequency": 2, "skip_tick_zero": True}])
@pytest.mark.parametrize("mode", ["snapshot", "changed", "history"])
def test_live_history_equals_the_batch(spark, sensor, tmp_path, options, mode):
    config = QueryConfig(
        "Q", "sensor_stream", (Aggregation("c", "count", "*"), Aggregation("s", "sum", "avg_speed")),
        ("road_id",), (Filter("ts", "=", CURRENT_TICK), Filter("avg_speed", ">", 1)),
    )
    batches = [[("A", 0, 1.0), ("B", 1, 2.0)], [("A", 2, 0.5), ("A", 4, 9.0)], [("B", 5, 3.0), ("B", 9, 4.0), ("A", 9, 0.0)]]
    rows, frames = arriving(spark, sensor, tmp_path, *batches)
    every = [f.withColumn("pkt_id", F.concat("pkt_id", F.lit(f"-{i}"))) for i, f in enumerate(frames)]
    whole = reduce(DataFrame.unionByName, every)
    out = str(tmp_path / "out")
    rows = rows.withColumn("pkt_id", F.concat("pkt_id", F.col("ts").cast("string"), "road_id"))
    stages.start_parts(spark, rows, "pkt_id", [config], out, f"{out}/c").awaitTermination()
    found = stages.live_history(spark, out, config, mode, **options)
    want = run_query(whole, config, mode, **options)
    assert rows_of(found, *want.columns) == rows_of(want, *want.columns)


def test_summary_versions_follow_the_stream(spark, sensor, tmp_path):
    rows, frames = arriving(spark, sensor, tmp_path, [("A", 1, 1.0), ("B", 1, 2.0)], [("A", 2, 5.0)])
    path = str(tmp_path / "summary")
    config = METRICS["SENSOR-METRICS"]
    live.start_summary(spark, rows, config, path, str(tmp_path / "c")).awaitTermination()
    want = run_metrics(frames[0].unionByName(frames[1]), config, "summary")
    assert rows_of(history.read_summary(spark, path), *want.columns) == rows_of(want, *want.columns)
    history.compact_summary(spark, path, f"{path}-compact")
    assert rows_of(history.read_summary(spark, f"{path}-compact"), *want.columns) == rows_of(want, *want.columns)


def test_many_summary_versions_stay_few_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(history, "RUNS_PER_LEVEL", 3)
    path, newest = str(tmp_path / "summary"), {}

    def write(version, *changes):
        rows = [("s", "m", "a", key, value, None, tick) for key, value, tick in changes]
        history.write_summary(spark.createDataFrame(rows, SUMMARY), path, version)

    def stored():
        return {r["dimensions"]: (r["value"], r["last_updated_tick"]) for r in history.read_summary(spark, path).collect()}

    for version in range(10):
        changes = [(f"k{version % 4}", float(version), version), ("hot", float(version), 5), ("old", float(version), -version)]
        write(version, *changes)
        newest |= {f"k{version % 4}": (float(version), version), "hot": (float(version), 5), "old": (0.0, 0)}
        assert stored() == newest
        # in base 3, the digits of the number of versions
        n, digits = version + 1, 0
        while n:
            n, digits = n // 3, digits + n % 3
        assert len(history.summary_runs(spark, path)) == digits
    write(9)  # the newest version again, now without rows
    assert stored() == newest | {"k1": (5.0, 5), "hot": (8.0, 5)}
    write(9, ("hot", 1.0, 6))
    assert stored() == newest | {"k1": (5.0, 5), "hot": (1.0, 6)}
    write(20)
    with pytest.raises(ValueError):
        write(3)
    with pytest.raises(ValueError):
        history.read_summary(spark, f"{path}-none")


@pytest.mark.parametrize("window", [WindowSpec(), WindowSpec("Sliding", 3, "seconds")])
@pytest.mark.parametrize("operator", [None, "<"])
def test_live_windows_over_parts_equal_the_batch(spark, sensor, tmp_path, window, operator):
    filters = (Filter("ts", operator, CURRENT_TICK),) if operator else ()
    config = QueryConfig(
        "W", "sensor_stream", (Aggregation("s", "sum", "avg_speed"), Aggregation("x", "max", "avg_speed")),
        ("road_id",), filters,
    )
    first = [("A", t, float(t)) for t in range(0, 12, 2)]
    rows, frames = arriving(spark, sensor, tmp_path, first, [("B", 1, 9.0), ("A", 7, 1.0)])
    stages.start_parts(
        spark, rows.selectExpr("concat(pkt_id, road_id, ts) AS pkt_id", "road_id", "avg_speed", "ts"),
        "pkt_id", [config], str(tmp_path / "out"), str(tmp_path / "c"),
    ).awaitTermination()
    batch = frames[0].unionByName(frames[1])
    for merge in (False, True):
        want = run_query(batch, config, "history", window=window, merge=merge)
        live_rows = stages.live_history(spark, str(tmp_path / "out"), config, window=window, merge=merge)
        assert rows_of(live_rows, *want.columns) == rows_of(want, *want.columns)


@pytest.mark.parametrize(("size", "operator"), [(3, None), (100, "<"), (2, "=")])
def test_live_row_windows_equal_the_batch(spark, sensor, tmp_path, size, operator):
    filters = (Filter("avg_speed", ">", 0), *((Filter("ts", operator, CURRENT_TICK),) if operator else ()))
    config = QueryConfig(
        "W", "sensor_stream", (Aggregation("s", "sum", "avg_speed"), Aggregation("x", "max", "avg_speed")),
        ("road_id",), filters,
    )
    window = WindowSpec("Tumbling", size, "events")
    first = [("AB"[t % 2], t // 3, float(t % 5)) for t in range(14)]
    late = [("A", 1, 9.0), ("B", 2, 4.0), ("A", 1, 7.0), ("C", 6, 0.0)]
    rows, frames = arriving(spark, sensor, tmp_path, first, late)
    named = "concat(pkt_id, road_id, ts, avg_speed) AS pkt_id", "road_id", "avg_speed", "ts"
    out = str(tmp_path / "out")
    stages.start_parts(
        spark, rows.selectExpr(*named), "pkt_id", [config], out, str(tmp_path / "c"), row_windows={"W": window}
    ).awaitTermination()
    stages.compact_newest(spark, out, config, window, "pkt_id", f"{out}/compact")
    whole = frames[0].unionByName(frames[1]).selectExpr(*named)
    for folder, merge, frequency in ((out, True, 2), (f"{out}/compact", False, 1)):
        options = {"merge": merge, "frequency": frequency}
        want = run_query(whole, config, "history", window=window, key="pkt_id", **options)
        found = stages.live_row_window(spark, folder, config, window, "pkt_id", **options)
        assert rows_of(found, *want.columns) == rows_of(want, *want.columns)


def test_a_tick_keeps_no_more_rows_than_the_window(spark, sensor, tmp_path):
    config = QueryConfig("W", "sensor_stream", (Aggregation("c", "count", "*"),), ())
    rows, _ = arriving(spark, sensor, tmp_path, [("A", 1, 1.0)] * 50, [("B", 1, 2.0)] * 60)
    out, window = str(tmp_path / "out"), WindowSpec("Sliding", 10, "packets")
    rows = rows.withColumn("pkt_id", F.concat("pkt_id", "road_id"))
    stages.start_parts(spark, rows, "pkt_id", [config], out, f"{out}/c", row_windows={"W": window}).awaitTermination()
    assert spark.read.parquet(f"{out}/newest/W").count() == 20
    assert rows_of(stages.read_counts(spark, out), "ts", "n") == [(1, 110)]
    stages.compact_newest(spark, out, config, window, "pkt_id", f"{out}/compact")
    assert spark.read.parquet(f"{out}/compact/newest/W").count() == 10


def test_parts_refuse_what_needs_rows(sensor):
    config = QueryConfig("W", "s", (Aggregation("c", "count"),), (), (Filter("vehicle_count", "<", CURRENT_TICK),))
    with pytest.raises(ConfigError):
        stages.parts_to_store(sensor(("A", 1, 1.0)), config)


def test_record_files_are_bounded_unless_a_column_deals_them_out(spark, sensor, tmp_path, monkeypatch):
    monkeypatch.setattr(xml, "RECORDS_PER_FILE", 10)
    rows = sensor(*(("A", t % 2, float(t)) for t in range(35))).coalesce(1)
    for by, sizes in ((None, [5, 10, 10, 10]), ("day", [17, 18])):
        path = str(tmp_path / f"by-{by}")
        xml.write_records(rows.withColumn("day", F.col("ts")), SENSOR, path, by)
        found = path + "/*" if by else path
        counts = xml.read_records(spark, SENSOR, found).groupBy("file_path").count()
        assert sorted(r["count"] for r in counts.collect()) == sizes
        columns = SENSOR.schema.fieldNames()
        assert rows_of(xml.ingest(spark, SENSOR, found), *columns) == rows_of(rows, *columns)


def test_a_batch_of_the_event_files_has_a_file_per_core(spark, tmp_path):
    events = spark.range(500).selectExpr("id AS event_id", "id % 7 AS user_id")
    events.write.parquet(str(tmp_path / "events.parquet"))
    sizes = []

    def store(batch, batch_id):
        found = batch.select(F.input_file_name().alias("file"), "event_id").collect()
        sizes.append((len({r["file"] for r in found}), len(found)))

    rows = workload._events_in_files(spark, str(tmp_path))
    rows.writeStream.foreachBatch(store).option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True
    ).start().awaitTermination()
    assert [files for files, _ in sizes] == [spark.sparkContext.defaultParallelism] * 3
    again = events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0).count()
    assert sum(n for _, n in sizes) == 500 + again


def test_the_first_row_of_a_key_is_kept_once(spark):
    rows = spark.createDataFrame(
        [(2, "p", "x", 1.0), (1, "p", "z", None), (1, "p", "y", 3.0), (1, "q", None, 4.0), (1, "q", "a", 0.0), (5, None, "n", 1.0)],
        "b long, k string, name string, v double",
    )
    found = stages.first_seen(rows, "k", ["b", "name", "v"])
    assert found.schema == rows.schema
    assert rows_of(found, *rows.columns) == sorted([(1, "p", "y", 3.0), (1, "q", None, 4.0), (5, None, "n", 1.0)], key=str)
    by_name = stages.first_seen(rows, "k", ["name"])
    assert rows_of(by_name, "k", "name") == sorted([("p", "x"), ("q", None), (None, "n")], key=str)
    # the state holds one copy of the row, not a row and what orders it
    assert "min_by" not in found._jdf.queryExecution().optimizedPlan().toString()
