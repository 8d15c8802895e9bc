"""Registered queries that read record files or run as streams, over the whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import WindowSpec, run_metrics, run_query
from tidemark.plans.seeds import COMPANIONS, METRICS, SEEDS
from tidemark.session import scratch_path
from tidemark.operators import series
from tidemark.sources import bindings, history, xml
from tidemark.sources.schemas import COMMAND, EVENT, SENSOR, Stream
from tidemark.streaming import live, stages
from tidemark.workload import batch

QUERIES = {}
register = batch.register


def keep(name: str):
    def put(function):
        register(name)(function)
        QUERIES[name] = batch.QUERIES[name]
        return function

    return put


def _written(rows: DataFrame, stream: Stream, by: str | None = None) -> str:
    """Write the rows as record files: one or more of bounded size per core, or one per value of ``by``."""
    spark = rows.sparkSession
    path = scratch_path(spark, "records")
    rows = rows.repartition(by) if by else rows.repartition(spark.sparkContext.defaultParallelism)
    xml.write_records(rows, stream, path, by)
    return path


@keep("xml_ingest_sensor")
def _(spark, folder):
    rows = bindings.sensor_stream(spark, folder)
    return xml.ingest(spark, SENSOR, _written(rows, SENSOR))


@keep("xml_ingest_event")
def _(spark, folder):
    return xml.ingest(spark, EVENT, _written(bindings.event_stream(spark, folder), EVENT))


@keep("xml_ingest_command")
def _(spark, folder):
    return xml.ingest(spark, COMMAND, _written(bindings.command_stream(spark, folder), COMMAND))


def _daily_files(spark, folder, times: int = 1) -> str:
    """Sensor records, one file per day; every fifth day has records whose count is no number.

    All files are written as often as ``times`` says, under other names.
    """
    day = F.floor(F.col("ts") / 24).cast("int")
    spoiled = (day % 5 == 0) & (F.col("vehicle_count") == 7)
    rows = bindings.sensor_stream(spark, folder).withColumns(
        {"day": day, "vehicle_count": F.when(spoiled, "seven").otherwise(F.col("vehicle_count").cast("string"))}
    )
    if times > 1:
        rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times))))
        rows = rows.withColumn("day", F.concat_ws("-", "day", "copy"))
    return _written(rows, SENSOR, by="day") + "/*"


@keep("xml_reject_file")
def _(spark, folder):
    return xml.ingest(spark, SENSOR, _daily_files(spark, folder))


@keep("xml_quarantine")
def _(spark, folder):
    rejected = xml.quarantine(spark, SENSOR, _daily_files(spark, folder))
    return rejected.agg(
        F.count_distinct("file_path").alias("files"),
        F.count("*").alias("records"),
        F.count(xml.FAULT).alias("bad_records"),
    )


@keep("xml_same_payload")
def _(spark, folder):
    """Every file arrives twice; what is taken and what is refused count once."""
    files = _daily_files(spark, folder, times=2)
    rejected = xml.quarantine(spark, SENSOR, files).agg(
        F.count_distinct("file_path").alias("refused_files"),
        F.count("*").alias("refused_records"),
        F.count(xml.FAULT).alias("bad_records"),
    )
    taken = xml.ingest(spark, SENSOR, files).agg(F.count("*").alias("taken_records"), F.max("ts").alias("newest_tick"))
    return taken.select(F.lit(1).alias("one"), "*").join(rejected.select(F.lit(1).alias("one"), "*"), "one").drop("one")


@keep("xml_query")
def _(spark, folder):
    rows = xml.ingest(spark, EVENT, _written(bindings.event_stream(spark, folder), EVENT))
    return run_query(rows, SEEDS["IS-EVT-PKT"], "history")


@keep("stream_equals_batch")
def _(spark, folder):
    """Record files through both live stages; the history then comes from the stored parts."""
    inbox = _written(bindings.event_stream(spark, folder), EVENT)
    out = scratch_path(spark, "live")
    stages.start_cleaning(spark, EVENT, inbox, out, f"{out}/checkpoint-1").awaitTermination()
    rows = stages.read_clean(spark, EVENT, out)
    stages.start_parts(
        spark, rows, EVENT.key, [SEEDS["RD-EVT-PKT"]], out, f"{out}/checkpoint-2"
    ).awaitTermination()
    return stages.live_history(spark, out, SEEDS["RD-EVT-PKT"])


def _events_in_files(spark, folder) -> DataFrame:
    """The events as a stream in three batches of a file per core, with every third row in a second file too."""
    rows = bindings.table(spark, folder, "events")
    path = scratch_path(spark, "arriving")
    again = rows.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0)
    files = max(2, spark.sparkContext.defaultParallelism)
    rows.unionByName(again).repartition(3 * files, F.rand(1)).write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def _live_parts(spark, folder, config, companions=()) -> str:
    out = scratch_path(spark, "live")
    rows = bindings.sensor_rows(_events_in_files(spark, folder))
    others = {config.query_id: companions}
    stages.start_parts(
        spark, rows, SENSOR.key, [config], out, f"{out}/checkpoint", companions=others
    ).awaitTermination()
    return out


@keep("stream_freq5")
def _(spark, folder):
    """Several micro-batches with repeated keys, evaluated at every fifth tick."""
    config = batch._sensor(*batch.BY_ROAD)
    return stages.live_history(spark, _live_parts(spark, folder, config), config, frequency=5)


@keep("stream_row_window")
def _(spark, folder):
    """A window of the newest 50 rows over several micro-batches with repeated keys, read from compacted newest rows."""
    config, window = batch.ROAD_WINDOW, WindowSpec("Sliding", 50, "packets")
    out = scratch_path(spark, "live")
    rows = bindings.sensor_rows(_events_in_files(spark, folder))
    stages.start_parts(
        spark, rows, SENSOR.key, [config], out, f"{out}/checkpoint", row_windows={config.query_id: window}
    ).awaitTermination()
    stages.compact_newest(spark, out, config, window, SENSOR.key, f"{out}/compact")
    return stages.live_row_window(spark, f"{out}/compact", config, window, SENSOR.key, merge=False)


@keep("stream_shared_clock")
def _(spark, folder):
    """Two live streams drive one clock."""
    out, other = scratch_path(spark, "live"), scratch_path(spark, "live")
    config = SEEDS["RD-EVT-PKT"]
    events = bindings.event_rows(_events_in_files(spark, folder))
    stages.start_parts(spark, events, EVENT.key, [config], out, f"{out}/checkpoint").awaitTermination()
    commands = bindings.command_rows(bindings.arriving(spark, folder, "orders"))
    stages.start_parts(spark, commands, COMMAND.key, [], other, f"{other}/checkpoint").awaitTermination()
    return stages.live_history(spark, out, config, clock=stages.read_ticks(spark, out, other))


@keep("stream_metrics_history")
def _(spark, folder):
    """The long metrics of a live stream over several batches with repeated keys."""
    out = scratch_path(spark, "live")
    config = METRICS["EVENT-METRICS"]
    rows = bindings.event_rows(_events_in_files(spark, folder))
    stages.start_parts(spark, rows, EVENT.key, [], out, f"{out}/checkpoint", metrics=[config]).awaitTermination()
    return stages.live_metric_history(spark, out, config)


@keep("stream_rd_occ")
def _(spark, folder):
    """A query whose derived metric needs the summary target of a companion."""
    config = SEEDS["RD-OCC-PKT"]
    others = [SEEDS[c] for c in COMPANIONS["RD-OCC-PKT"]]
    out = _live_parts(spark, folder, config, others)
    return stages.live_history(spark, out, config, "snapshot", companions=others)


@keep("stream_parts_history")
def _(spark, folder):
    """Table rows as a stream, remembered keys bounded by a horizon longer than the data."""
    out = scratch_path(spark, "live")
    rows = bindings.sensor_rows(bindings.arriving(spark, folder, "events"))
    config = SEEDS["RD-SPEED-PKT"]
    stages.start_parts(
        spark, rows, SENSOR.key, [config], out, f"{out}/checkpoint", horizon="100000 seconds"
    ).awaitTermination()
    stages.compact_parts(spark, out, config, f"{out}/compact")
    return stages.live_history(spark, f"{out}/compact", config, "changed")


def _last_batch(df: DataFrame, mode: str) -> DataFrame:
    """Run a streaming query over all data there is and read what its last batch wrote."""
    spark = df.sparkSession
    out = scratch_path(spark, "live")

    def store(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/rows/v={batch_id}")

    df.writeStream.outputMode(mode).foreachBatch(store).option(
        "checkpointLocation", f"{out}/checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()
    written = spark.read.parquet(f"{out}/rows")
    if mode == "complete":
        written = written.where(F.col("v") == written.agg(F.max("v")).scalar())
    return written.drop("v")


@keep("stream_snapshot")
def _(spark, folder):
    rows = bindings.sensor_rows(bindings.arriving(spark, folder, "events"))
    return _last_batch(live.live_snapshot(rows, SEEDS["IS-SPEED-PKT"]), "complete")


@keep("stream_windows")
def _(spark, folder):
    rows = bindings.command_rows(bindings.arriving(spark, folder, "orders"))
    config = batch.QueryConfig(
        "Q", "command_stream",
        (batch.Aggregation("c_cmd", "count", "*"), batch.Aggregation("x_dur", "max", "duration")),
        ("action",),
    )
    windows = live.live_windows(rows, config, WindowSpec("Tumbling", 30, "seconds"), "0 seconds")
    return _last_batch(windows, "complete")


@keep("stream_summary")
def _(spark, folder):
    rows = bindings.event_rows(bindings.arriving(spark, folder, "events"))
    out = scratch_path(spark, "live")
    live.start_summary(
        spark, rows, METRICS["EVENT-METRICS"], f"{out}/summary", f"{out}/checkpoint"
    ).awaitTermination()
    return history.read_summary(spark, f"{out}/summary")


@keep("stream_summary_runs")
def _(spark, folder):
    """The summary after ten batches, most of which were merged into one run."""
    out = scratch_path(spark, "live")
    events = bindings.table(spark, folder, "events")
    events.repartition(10).write.parquet(f"{out}/inbox")
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/inbox")
    live.start_summary(
        spark, bindings.event_rows(arriving), METRICS["EVENT-METRICS"], f"{out}/summary", f"{out}/checkpoint"
    ).awaitTermination()
    return history.read_summary(spark, f"{out}/summary")


@keep("stored_window")
def _(spark, folder):
    """The stream stored in folders of ticks; a time window reads only the newest of them."""
    path = scratch_path(spark, "rows")
    history.write_stream_table(bindings.sensor_stream(spark, folder), path, ticks_per_folder=64)
    return history.read_stream_table(spark, path, last_ticks=20, ticks_per_folder=64)


def _typed(spark, folder, query_id: str, rows: DataFrame) -> str:
    """Results stored twice as one batch: the second time replaces the first."""
    path = scratch_path(spark, "results")
    for _ in range(2):
        history.append_results(rows, path, query_id)
    return path


@keep("series_wide_typed")
def _(spark, folder):
    rows = run_query(bindings.sensor_stream(spark, folder), SEEDS["RD-SPEED-PKT"], "history")
    stored = history.read_results(spark, _typed(spark, folder, "RD-SPEED-PKT", rows), "RD-SPEED-PKT")
    return series.wide_points(stored, "avg_speed", "road_id", "I102_R3", 100)


@keep("series_long_typed")
def _(spark, folder):
    rows = run_metrics(bindings.sensor_stream(spark, folder), batch.MANY)
    stored = history.read_results(spark, _typed(spark, folder, "SENSOR-METRICS", rows), "SENSOR-METRICS")
    return series.long_series(stored, "road_id", "avg_speed", "avg", "I102_R3", 200)


@keep("latest_snapshot_typed")
def _(spark, folder):
    rows = run_query(bindings.sensor_stream(spark, folder), SEEDS["RD-SPEED-PKT"], "history")
    newest = history.newest_result(spark, _typed(spark, folder, "RD-SPEED-PKT", rows), "RD-SPEED-PKT")
    return newest.select("ts", "road_id", F.col("x_spd").cast("double").alias("x_spd"), F.col("c_pkt").cast("long").alias("c_pkt"))


@keep("stored_history_retry")
def _(spark, folder):
    """Two batches, of which the second is stored again, first with other rows and at last without any."""
    config = SEEDS["RD-VEH-PKT"]
    rows = run_query(bindings.sensor_stream(spark, folder), config, "changed")
    path = scratch_path(spark, "results")
    early = rows.where("ts < 500")
    history.append_results(early, path, config.query_id, 0)
    for again in (rows.where("ts >= 500"), rows.where("ts >= 900"), rows.where("ts < 0")):
        history.append_results(again, path, config.query_id, 1)
    stored = history.read_results(spark, path, config.query_id, 100)
    return stored.groupBy("ts").agg(F.count("*").alias("groups")).select(F.col("ts").cast("long").alias("ts"), "groups")


@keep("stored_history")
def _(spark, folder):
    path = scratch_path(spark, "history")
    for query_id in ("RD-VEH-PKT", "IS-VEH-PKT"):
        config = SEEDS[query_id]
        rows = run_query(bindings.sensor_stream(spark, folder), config, "changed")
        stored = history.json_history(rows, query_id, list(config.group_by))
        for _ in range(2):  # a repeated batch replaces its own rows
            history.append_history(stored, path, query_id, 7)
    stored = history.read_history(spark, path)
    return history.parsed_history(stored).select(
        "query_id", "ts", F.size("result").cast("long").alias("objects")
    )
