"""Registered batch queries: each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType

from tidemark import Aggregation, DerivedMetric, Filter, QueryConfig, SummaryUpdate, WindowSpec, run_metrics, run_query, run_sql, run_tick
from tidemark.config import CURRENT_TICK
from tidemark.functions import values
from tidemark.operators import clock, landmark, retention, series, tables
from tidemark.plans.seeds import COMPANIONS, METRICS, OCCUPANCY_EXAMPLE, SEEDS
from tidemark.sources import bindings, history

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

NOW = Filter("ts", "=", CURRENT_TICK)
ROAD = ("road_id", "intersection_id")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and integers as bigints, for comparison by value."""
    columns = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DecimalType):
            columns.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, IntegerType):
            columns.append(F.col(f.name).cast("long").alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def register(name: str):
    def keep(function):
        QUERIES[name] = lambda spark, folder: plain(function(spark, folder))
        return function

    return keep


def _sensor(*aggregations: Aggregation, by=ROAD, filters=(NOW,), **extra) -> QueryConfig:
    return QueryConfig("Q", "sensor_stream", aggregations, tuple(by), tuple(filters), **extra)


SPEED_SUM = Aggregation("s_spd", "sum", "avg_speed")
SPEED_MAX = Aggregation("x_spd", "max", "avg_speed")
SPEED_MIN = Aggregation("n_spd", "min", "avg_speed")
PACKETS = Aggregation("c_pkt", "count", "*")
SPEED_AVG = Aggregation("a_spd", "avg", "avg_speed", count_field="c_pkt")
BY_ROAD = (SPEED_SUM, SPEED_MAX, SPEED_MIN, PACKETS)


# --- beginning-to-now snapshots of the built-in queries ---------------------------------------

def _seed(query_id: str):
    config = SEEDS[query_id]
    stream = bindings.sensor_stream if config.source == "sensor_stream" else bindings.event_stream
    others = [SEEDS[c] for c in COMPANIONS.get(query_id, ())]
    return lambda spark, folder: run_query(stream(spark, folder), config, companions=others)


for _id in SEEDS:
    register("snap_" + _id.removesuffix("-PKT").lower().replace("-", "_"))(_seed(_id))


# --- histories ---------------------------------------------------------------------------------

@register("hist_rd_speed_dense")
def _(spark, folder):
    return run_query(bindings.sensor_stream(spark, folder), SEEDS["RD-SPEED-PKT"], "history")


@register("hist_rd_speed_sparse")
def _(spark, folder):
    return run_query(bindings.sensor_stream(spark, folder), SEEDS["RD-SPEED-PKT"], "changed")


@register("hist_none_latest")
def _(spark, folder):
    config = _sensor(Aggregation("v_spd", "none", "avg_speed"), SPEED_AVG, PACKETS)
    return run_query(bindings.sensor_stream(spark, folder), config, "history")


@register("snap_none_latest")
def _(spark, folder):
    config = _sensor(Aggregation("v_spd", "none", "avg_speed"), PACKETS)
    return run_query(bindings.sensor_stream(spark, folder), config)


@register("hist_freq5")
def _(spark, folder):
    return run_query(bindings.sensor_stream(spark, folder), _sensor(*BY_ROAD), "history", frequency=5)


@register("due_ticks_gappy")
def _(spark, folder):
    ticks = clock.ticks_of(bindings.sensor_stream(spark, folder, minutes=True))
    return clock.due_ticks(ticks, 3)


@register("hist_gappy_freq30")
def _(spark, folder):
    rows = bindings.sensor_stream(spark, folder, minutes=True)
    return run_query(rows, _sensor(*BY_ROAD), "changed", frequency=30)


@register("hist_skip_tick_zero")
def _(spark, folder):
    return run_query(
        bindings.sensor_stream(spark, folder), _sensor(*BY_ROAD, by=("intersection_id",)), "history",
        skip_tick_zero=True,
    )


@register("hist_shared_clock")
def _(spark, folder):
    rows = bindings.event_stream(spark, folder)
    ticks = clock.ticks_of(rows, bindings.command_stream(spark, folder))
    return run_query(rows, SEEDS["RD-EVT-PKT"], "history", clock=ticks)


@register("hist_global")
def _(spark, folder):
    config = QueryConfig(
        "Q", "command_stream",
        (
            Aggregation("s_dur", "sum", "duration"),
            Aggregation("a_dur", "avg", "duration"),
            Aggregation("c_cmd", "count", "*"),
            Aggregation("x_dur", "max", "duration"),
        ),
        (), (NOW, Filter("action", "=", "P")),
    )
    rows = bindings.command_stream(spark, folder)
    ticks = clock.ticks_of(rows, bindings.event_stream(spark, folder))
    return run_query(rows, config, "history", clock=ticks)


@register("hist_shipments_sparse")
def _(spark, folder):
    config = QueryConfig(
        "Q", "shipments",
        (
            Aggregation("s_qty", "sum", "l_quantity"),
            Aggregation("a_price", "avg", "l_extendedprice"),
            Aggregation("x_price", "max", "l_extendedprice"),
            Aggregation("n_price", "min", "l_extendedprice"),
            Aggregation("c_all", "count", "*"),
        ),
        ("l_returnflag", "l_linestatus"), (NOW,),
    )
    return run_query(bindings.shipments(spark, folder), config, "changed")


@register("hist_by_text")
def _(spark, folder):
    config = QueryConfig(
        "Q", "event_stream",
        (
            Aggregation("x_type", "max", "event_type"),
            Aggregation("n_type", "min", "event_type"),
            Aggregation("c_type", "count", "event_type"),
        ),
        ("intersection_id",), (NOW,),
    )
    return run_query(bindings.event_stream(spark, folder), config, "changed")


# --- filters that compare with the current tick -------------------------------------------------

def _tick_query(field: str, operator: str, *, merge: bool, window=None):
    config = _sensor(SPEED_SUM, SPEED_MAX, SPEED_MIN, PACKETS, by=("intersection_id",),
                     filters=(Filter(field, operator, CURRENT_TICK),))

    def run(spark, folder):
        return run_query(
            bindings.sensor_stream(spark, folder), config, "history", merge=merge, window=window, key="pkt_id"
        )

    return run


register("hist_tick_le")(_tick_query("ts", "<=", merge=True))
register("tick_lt")(_tick_query("ts", "<", merge=False))
register("tick_ge")(_tick_query("ts", ">=", merge=False))
register("tick_ne")(_tick_query("ts", "!=", merge=False))
register("tick_gt")(_tick_query("ts", ">", merge=False))
register("tick_lt_sliding")(
    _tick_query("ts", "<", merge=False, window=WindowSpec("Sliding", 5, "seconds"))
)
register("field_le_tick")(_tick_query("vehicle_count", "<=", merge=False))
register("field_ge_tick")(_tick_query("vehicle_count", ">=", merge=False))
register("field_ne_tick")(_tick_query("vehicle_count", "!=", merge=False))


# --- aggregates and filters ---------------------------------------------------------------------

@register("global_agg")
def _(spark, folder):
    aggregations = (*BY_ROAD, SPEED_AVG, Aggregation("c_veh", "count", "vehicle_count"),
                    Aggregation("s_veh", "sum", "vehicle_count"))
    return run_query(bindings.sensor_stream(spark, folder), _sensor(*aggregations, by=()))


def _filtered(*filters: Filter):
    config = _sensor(*BY_ROAD, filters=(NOW, *filters))
    return lambda spark, folder: run_query(bindings.sensor_stream(spark, folder), config)


register("filter_eq")(_filtered(Filter("road_id", "=", "I101_R2")))
register("filter_eq_decimal")(_filtered(Filter("avg_speed", "=", 12.31)))
register("filter_ne")(_filtered(Filter("road_id", "!=", "I101_R2")))
register("filter_ltgt")(_filtered(Filter("vehicle_count", "<>", 30)))
register("filter_gt")(_filtered(Filter("avg_speed", ">", 39.6)))
register("filter_ge")(_filtered(Filter("vehicle_count", ">=", "50")))
register("filter_lt")(_filtered(Filter("vehicle_count", "<", 49.5)))
register("filter_le")(_filtered(Filter("occupancy", "<=", 10)))
register("filter_and")(_filtered(Filter("vehicle_count", ">", 20), Filter("avg_speed", "<", 50),
                                 Filter("intersection_id", "=", "I102")))
register("filter_null")(_filtered(Filter("road_id", "=", None)))


@register("filter_none")
def _(spark, folder):
    return run_query(bindings.sensor_stream(spark, folder), _sensor(*BY_ROAD, filters=()), merge=False,
                     mode="history", frequency=100)


@register("result_filter")
def _(spark, folder):
    rows = run_query(bindings.sensor_stream(spark, folder), _sensor(*BY_ROAD), "changed")
    return rows.where(F.trim(F.col("c_pkt").cast("string")) == "5")


# --- summary updates, derived metrics, stored fields ---------------------------------------------

@register("summary_updates")
def _(spark, folder):
    config = _sensor(
        SPEED_SUM, SPEED_MAX, PACKETS,
        summary_updates=(
            SummaryUpdate("sum_speed", "s_spd", "increment"),
            SummaryUpdate("max_speed", "x_spd", "max"),
            SummaryUpdate("busiest", "c_pkt", "max"),
            SummaryUpdate("quietest", "c_pkt", "min"),
            SummaryUpdate("last_count", "c_pkt", "replace"),
            SummaryUpdate("peak_total", "x_spd", "increment"),
        ),
    )
    return run_query(bindings.sensor_stream(spark, folder), config)


@register("derived_metrics")
def _(spark, folder):
    return run_query(bindings.sensor_stream(spark, folder), QueryConfig.from_dict(OCCUPANCY_EXAMPLE), "changed")


@register("store_fields")
def _(spark, folder):
    config = QueryConfig.from_dict(OCCUPANCY_EXAMPLE)
    return landmark.stored(run_query(bindings.sensor_stream(spark, folder), config, "changed"), config)


@register("standard_names")
def _(spark, folder):
    config = _sensor(Aggregation("a", "avg", "speed"), Aggregation("b", "count", "*")).with_standard_names()
    return run_query(bindings.sensor_stream(spark, folder), config)


# --- one tick at a time --------------------------------------------------------------------------

@register("tick_result")
def _(spark, folder):
    rows = bindings.sensor_stream(spark, folder)
    tick = rows.agg(F.max("ts")).first()[0]
    return run_tick(rows, _sensor(*BY_ROAD, SPEED_AVG), tick)


@register("tick_result_retained")
def _(spark, folder):
    rows = bindings.sensor_stream(spark, folder)
    tick = rows.agg(F.max("ts")).first()[0] - 24
    config = _sensor(SPEED_SUM, Aggregation("a_spd", "avg", "avg_speed"), by=("intersection_id",), filters=())
    return run_tick(rows, config, tick, window=WindowSpec("Sliding", 77, "packets"), key="pkt_id")


@register("merge_snapshots")
def _(spark, folder):
    """The first half's snapshot with the second half folded in."""
    rows = bindings.sensor_stream(spark, folder)
    half = rows.agg(F.floor(F.max("ts") / 2)).scalar()
    config = _sensor(*BY_ROAD, SPEED_AVG, Aggregation("v_spd", "none", "avg_speed"))
    older = run_query(rows.where(F.col("ts") <= half), config)
    newer = run_query(rows.where(F.col("ts") > half), config).withColumn("note", F.lit("second half"))
    merged = landmark.merge_snapshots(older, newer, config)
    return merged.withColumn("a_spd", F.round("a_spd", 6))


# --- long-format metrics ---------------------------------------------------------------------------

MANY = QueryConfig(
    "SENSOR-METRICS", "sensor_stream",
    (
        Aggregation("a", "avg", "speed"),
        Aggregation("b", "sum", "vehicle_count"),
        Aggregation("c", "min", "occupancy"),
        Aggregation("d", "none", "vehicle_count"),
        Aggregation("e", "count", "*"),
    ),
    ROAD, (NOW,), dimension_fields=ROAD,
)


@register("metrics_long_changed")
def _(spark, folder):
    return run_metrics(bindings.sensor_stream(spark, folder), MANY)


@register("metrics_default_dimensions")
def _(spark, folder):
    """A config that names no dimensions has those of its stream."""
    return run_metrics(bindings.sensor_stream(spark, folder), replace(MANY, dimension_fields=None))


@register("metrics_long_events")
def _(spark, folder):
    return run_metrics(bindings.event_stream(spark, folder), METRICS["EVENT-METRICS"])


@register("metrics_long_summary")
def _(spark, folder):
    return run_metrics(bindings.sensor_stream(spark, folder), MANY, "summary")


@register("metrics_long_fallback")
def _(spark, folder):
    rows = bindings.event_stream(spark, folder)
    ticks = clock.ticks_of(rows, bindings.command_stream(spark, folder))
    return run_metrics(rows, METRICS["EVENT-METRICS"], clock=ticks)


@register("summary_lookup")
def _(spark, folder):
    summary = run_metrics(bindings.sensor_stream(spark, folder), METRICS["SENSOR-METRICS"], "summary")
    wanted = run_metrics(bindings.event_stream(spark, folder), METRICS["EVENT-METRICS"], "summary").select(
        F.lit("sensor_stream").alias("stream_name"), F.lit("speed").alias("metric_field"),
        F.lit("avg").alias("aggregate_name"), "dimensions",
    ).distinct()
    return tables.summary_lookup(summary, wanted)


# --- retention and windows --------------------------------------------------------------------------

def _retained(stream, key: str, window: WindowSpec):
    return lambda spark, folder: retention.retained(stream(spark, folder), window, key)


SENSOR = (bindings.sensor_stream, "pkt_id")
EVENT = (bindings.event_stream, "event_id")
COMMAND = (bindings.command_stream, "cmd_id")
register("retain_sliding_seconds")(_retained(*SENSOR, WindowSpec("Sliding", 5, "seconds")))
register("retain_sliding_rows")(_retained(*SENSOR, WindowSpec("Sliding", 137, "packets")))
register("retain_tumbling_seconds")(_retained(*EVENT, WindowSpec("Tumbling", 24, "seconds")))
register("retain_tumbling_rows")(_retained(*EVENT, WindowSpec("Tumbling", 10, "events")))
register("retain_large_rows")(_retained(*SENSOR, WindowSpec("Sliding", 12_000, "packets")))
register("retain_sliding_events")(_retained(*EVENT, WindowSpec("Sliding", 55, "events")))
register("retain_landmark")(_retained(*COMMAND, WindowSpec("Landmark")))
register("retain_unknown_unit")(_retained(*COMMAND, WindowSpec("Sliding", 5, "")))


@register("retain_rows_cutoff")
def _(spark, folder):
    return retention.newest_rows(bindings.command_stream(spark, folder), 1234, "cmd_id")


@register("evicted_rows")
def _(spark, folder):
    return retention.evicted(
        bindings.sensor_stream(spark, folder), WindowSpec("Sliding", 100, "seconds"), "pkt_id"
    ).select("pkt_id", "ts")


def _last_digit():
    return F.substring("pkt_id", -1, 1).cast("int")


@register("retain_null_ticks")
def _(spark, folder):
    """Rows without a tick are the oldest."""
    rows = bindings.sensor_stream(spark, folder)
    some = rows.withColumn("ts", F.when(_last_digit() % 2 == 0, F.col("ts")))
    many = rows.count() * 3 // 4
    return retention.retained(some, WindowSpec("Sliding", many, "packets"), "pkt_id").select("pkt_id", "ts")


@register("evicted_by_rows")
def _(spark, folder):
    rows = bindings.sensor_stream(spark, folder)
    return retention.evicted(rows, WindowSpec("Sliding", 137, "packets"), "pkt_id").select("pkt_id", "ts")


@register("derived_nested")
def _(spark, folder):
    """Divisions by zero, by numbers and by brackets."""
    metrics = (
        DerivedMetric("zero", "s_spd / (c_pkt - c_pkt)"),
        DerivedMetric("by_zero", "s_spd / c_pkt / 0"),
        DerivedMetric("nested", "-(x_spd - s_spd / c_pkt) * 2 / (x_spd + 1.5)"),
    )
    config = _sensor(SPEED_SUM, SPEED_MAX, PACKETS, derived_metrics=metrics)
    return run_query(bindings.sensor_stream(spark, folder), config)


@register("field_lt_tick_large")
def _(spark, folder):
    """A field far beyond all ticks, and one that is no number."""
    far = F.when(_last_digit() % 3 == 0, 1e19).when(_last_digit() % 3 == 1, float("nan")).otherwise(-1e19)
    rows = bindings.sensor_stream(spark, folder).withColumn("occupancy", far)
    config = _sensor(PACKETS, filters=(Filter("occupancy", "<", CURRENT_TICK),), by=("road_id",))
    return run_query(rows, config, "history", merge=False)


ROAD_WINDOW = _sensor(SPEED_SUM, SPEED_MAX, SPEED_MIN, SPEED_AVG, PACKETS, by=("road_id",), filters=())


def _windowed(window: WindowSpec | None, merge: bool, frequency: int = 1):
    return lambda spark, folder: run_query(
        bindings.sensor_stream(spark, folder), ROAD_WINDOW, "history",
        window=window, merge=merge, frequency=frequency, key="pkt_id",
    )


register("query_sliding_seconds")(_windowed(WindowSpec("Sliding", 5, "seconds"), False))
register("query_sliding_seconds_merged")(_windowed(WindowSpec("Sliding", 5, "seconds"), True))
register("query_sliding_seconds_freq")(_windowed(WindowSpec("Sliding", 40, "seconds"), False, 7))
register("query_sliding_rows")(_windowed(WindowSpec("Sliding", 50, "packets"), False))
register("query_landmark")(_windowed(None, False))


@register("query_rows_at_tick")
def _(spark, folder):
    config = _sensor(SPEED_SUM, PACKETS, by=("intersection_id",))
    return run_query(bindings.sensor_stream(spark, folder), config, "history",
                     window=WindowSpec("Tumbling", 4, "packets"), merge=False, key="pkt_id")


def _aligned(window: WindowSpec):
    config = _sensor(SPEED_SUM, SPEED_MAX, PACKETS, by=("road_id",), filters=())
    return lambda spark, folder: retention.aligned(
        bindings.sensor_stream(spark, folder), config, window, "pkt_id"
    )


register("window_tumbling_aligned")(_aligned(WindowSpec("Tumbling", 24, "seconds")))
register("window_sliding_aligned")(_aligned(WindowSpec("Sliding", 24, "seconds", slide=6)))
register("window_slide_gaps")(_aligned(WindowSpec("Sliding", 5, "seconds", slide=10)))
register("window_rows_aligned")(_aligned(WindowSpec("Tumbling", 100, "packets")))


# --- tables -----------------------------------------------------------------------------------------

def _top(stream, key: str, source: str):
    return lambda spark, folder: tables.table_view(tables.newest(stream(spark, folder), key), source)


register("top1000_sensor")(_top(*SENSOR, "sensor_stream"))
register("top1000_event")(_top(*EVENT, "event_stream"))
register("top1000_command")(_top(*COMMAND, "command_stream"))


@register("dedup_first_wins")
def _(spark, folder):
    return tables.first_wins(
        bindings.shipments(spark, folder), ["l_orderkey", "l_linenumber"],
        ["ts", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"],
    )


@register("payload_copies")
def _(spark, folder):
    files = bindings.table(spark, folder, "documents").select(
        F.col("doc_id").alias("path"), F.encode("text", "utf-8").alias("content"), F.col("source"),
        F.col("n_chars").alias("modificationTime"),
    )
    return tables.payload_copies(files).select("digest", "path")


@register("table_counts")
def _(spark, folder):
    return tables.row_counts({
        "sensor_stream": bindings.sensor_stream(spark, folder),
        "event_stream": bindings.event_stream(spark, folder),
        "command_stream": bindings.command_stream(spark, folder),
    })


@register("reset_audit")
def _(spark, folder):
    rows = bindings.sensor_stream(spark, folder)
    return tables.reset_audit(
        {
            "sensor_stream": rows,
            "event_stream": bindings.event_stream(spark, folder),
            "command_stream": bindings.command_stream(spark, folder),
            "summary": run_metrics(rows, METRICS["SENSOR-METRICS"], "summary"),
        },
        clock.ticks_of(rows),
    )


def _halves(spark, folder):
    """The sensor summaries over the first half of the ticks and over all of them."""
    rows = bindings.sensor_stream(spark, folder)
    half = rows.agg(F.floor(F.max("ts") / 2)).scalar()
    config = METRICS["SENSOR-METRICS"]
    return run_metrics(rows.where(F.col("ts") <= half), config, "summary"), run_metrics(rows, config, "summary")


@register("summary_upsert")
def _(spark, folder):
    old, new = _halves(spark, folder)
    return tables.upsert(old, new, tables.SUMMARY_KEY, "last_updated_tick")


@register("catalogue_upsert")
def _(spark, folder):
    old = bindings.table(spark, folder, "customer").select(
        "c_custkey", F.col("c_name").alias("description"),
        F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("query_config"),
    )
    new = bindings.table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderpriority").alias("description"), F.min("o_orderpriority").alias("query_config")
    )
    return tables.fill_missing(old, new, ["c_custkey"], ["query_config"])


@register("schema_evolve")
def _(spark, folder):
    return tables.grown(
        bindings.event_stream(spark, folder).select("event_id", "event_type", "ts"),
        bindings.command_stream(spark, folder).select(F.col("cmd_id").alias("event_id"), "ts", "duration"),
    )


@register("invalidate_history")
def _(spark, folder):
    kept, _ = _invalidated(spark, folder)
    return kept


@register("invalidate_summary")
def _(spark, folder):
    _, kept = _invalidated(spark, folder)
    return kept


def _invalidated(spark, folder):
    rows, events = bindings.sensor_stream(spark, folder), bindings.event_stream(spark, folder)
    speed = run_query(rows, SEEDS["IS-SPEED-PKT"], "changed").select(F.lit("IS-SPEED-PKT").alias("query_id"), "ts")
    vehicles = run_query(rows, SEEDS["IS-VEH-PKT"], "changed").select(F.lit("IS-VEH-PKT").alias("query_id"), "ts")
    summary = run_metrics(rows, METRICS["SENSOR-METRICS"], "summary").unionByName(
        run_metrics(events, METRICS["EVENT-METRICS"], "summary")
    )
    changed = spark.sql("SELECT 'IS-SPEED-PKT' AS query_id, 'sensor_stream' AS source")
    return tables.invalidated(speed.unionByName(vehicles), summary, changed)


@register("orphan_dims")
def _(spark, folder):
    return tables.foreign_key_audit(bindings.dimensions(spark, folder))


@register("orphan_rows")
def _(spark, folder):
    dims = bindings.dimensions(spark, folder)
    return tables.orphans(dims["traffic_signal"], dims["road"], ["road_id", "intersection_id"]).select(
        "signal_id", "road_id", "intersection_id"
    )


# --- logical time -----------------------------------------------------------------------------------

@register("current_tick")
def _(spark, folder):
    return clock.current_tick(bindings.command_stream(spark, folder))


@register("clock_after_batches")
def _(spark, folder):
    lines = bindings.shipments(spark, folder).select("l_orderkey", "l_linenumber", "l_partkey", "ts")
    first = lines.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("__first"))
    marked = lines.join(first, ["l_orderkey", "l_linenumber"]).select(
        F.col("l_partkey").alias("batch"), "ts", (F.col("l_partkey") == F.col("__first")).alias("is_new")
    )
    return clock.clock_after_batches(marked, "batch", "is_new")


@register("raw_sql")
def _(spark, folder):
    rows = bindings.sensor_stream(spark, folder)
    tick = rows.agg(F.max("ts")).first()[0]
    text = (
        "SELECT road_id, count(*) AS c_pkt, max(avg_speed) AS x_spd FROM sensor_stream "
        "WHERE ts <= {CURRENT_TICK} AND ts > {CURRENT_TICK} - 48 GROUP BY road_id"
    )
    return run_sql(spark, text, tick, {"sensor_stream": rows})


# --- result history and series ------------------------------------------------------------------------

def _json(spark, folder) -> DataFrame:
    rows = run_query(bindings.sensor_stream(spark, folder), SEEDS["RD-SPEED-PKT"], "history")
    return history.json_history(rows, "RD-SPEED-PKT", list(ROAD))


def _metric_json(spark, folder) -> DataFrame:
    rows = run_metrics(bindings.sensor_stream(spark, folder), MANY)
    return history.json_history(rows, "SENSOR-METRICS", ["field", "field_value", "metric", "aggregate"])


@register("history_json")
def _(spark, folder):
    item = F.col("item")
    return series.exploded(_json(spark, folder)).select(
        "query_id", "ts", item["road_id"].alias("road_id"), item["intersection_id"].alias("intersection_id"),
        item["s_spd"].cast("double").alias("s_spd"), item["c_pkt"].cast("long").alias("c_pkt"),
        item["avg_speed"].cast("double").alias("avg_speed"),
    )


@register("history_parsed")
def _(spark, folder):
    return history.parsed_history(_json(spark, folder)).select(
        "query_id", "ts", F.size("result").cast("long").alias("objects")
    )


@register("latest_snapshot")
def _(spark, folder):
    item = F.col("item")
    return series.exploded(series.latest_result(_json(spark, folder))).select(
        "ts", item["road_id"].alias("road_id"), item["x_spd"].cast("double").alias("x_spd"),
        item["c_pkt"].cast("long").alias("c_pkt"),
    )


@register("last_tick_of_query")
def _(spark, folder):
    return series.last_tick(_json(spark, folder))


@register("series_wide")
def _(spark, folder):
    return series.wide_series(_json(spark, folder), "RD-SPEED-PKT", "avg_speed", "road_id", "I102_R3", 100).drop("id")


@register("series_fields")
def _(spark, folder):
    return series.field_names(_json(spark, folder), "RD-SPEED-PKT")


@register("series_long")
def _(spark, folder):
    rows = series.long_rows(_metric_json(spark, folder))
    return series.long_series(rows, "road_id", "avg_speed", "avg", "I102_R3", 200)


@register("series_old_shape")
def _(spark, folder):
    """Results stored before fields were named: the dimension is a column of its own."""
    config = _sensor(Aggregation("value", "avg", "avg_speed"), by=("road_id",))
    rows = run_query(bindings.sensor_stream(spark, folder), config, "changed").withColumns(
        {"metric_field": F.lit("avg_speed"), "aggregate": F.lit("avg")}
    )
    stored = history.json_history(rows, "OLD", ["road_id"])
    return series.long_series(series.long_rows(stored), "road_id", "speed", "avg", "I102_R3", 200)


@register("object_lists")
def _(spark, folder):
    """A lone object, no JSON, and a list with elements that are no objects."""
    props = F.col("props")
    count = lambda text: F.size(values.object_list(text)).cast("long")
    mixed = F.concat(F.lit("["), props, F.lit(', 7, "x", null, '), props, F.lit("]"))
    return bindings.table(spark, folder, "events").select(
        "event_id",
        count(props).alias("lone"),
        count(F.concat(F.lit("x"), props)).alias("garbage"),
        count(mixed).alias("listed"),
        values.object_list(mixed)[1]["k"].cast("long").alias("k"),
    )


@register("series_available")
def _(spark, folder):
    return series.available(series.long_rows(_metric_json(spark, folder)))


@register("series_available_top")
def _(spark, folder):
    return series.available(series.long_rows(_metric_json(spark, folder)), 200)


@register("number_values")
def _(spark, folder):
    """Text columns read as numbers: what is not a number becomes zero."""
    rows = bindings.table(spark, folder, "conversations")
    return rows.groupBy("role").agg(
        F.sum(values.number_or(F.trim("text"), 0)).alias("as_numbers"),
        F.sum(values.number_or(F.col("turn").cast("string"), 0)).alias("turns"),
        F.count("*").alias("n"),
    )


@register("display_values")
def _(spark, folder):
    rows = run_query(bindings.sensor_stream(spark, folder), SEEDS["IS-OCC-PKT"])
    return rows.select(
        F.lower("intersection_id").alias("low"), F.initcap(F.lower("intersection_id")).alias("title"),
        F.round("s_occ", 1).alias("s1"), F.round("x_occ", 2).alias("x2"),
        values.whole_number_text(F.col("c_pkt").cast("double")).alias("c_text"),
    )
