"""For each registered query, the same result in SQL over the tables."""

from __future__ import annotations

SENSOR = """sensor AS (
  SELECT 'PKT_' || CASE WHEN length(CAST(event_id AS VARCHAR)) < 6
                        THEN lpad(CAST(event_id AS VARCHAR), 6, '0') ELSE CAST(event_id AS VARCHAR) END AS pkt_id,
         'I' || CAST(101 + user_id % 3 AS VARCHAR) AS intersection_id,
         'I' || CAST(101 + user_id % 3 AS VARCHAR) || '_R' || CAST(1 + user_id % 4 AS VARCHAR) AS road_id,
         'I' || CAST(101 + user_id % 3 AS VARCHAR) || '_R' || CAST(1 + user_id % 4 AS VARCHAR) || '_TL' AS signal_id,
         CAST(json_extract_string(props, '$.k') AS INT) AS vehicle_count,
         CAST(value AS DECIMAL(18,3)) AS avg_speed,
         CAST(CAST(value AS DECIMAL(18,3)) * CAST(0.2 AS DECIMAL(2,1)) AS DECIMAL(18,3)) AS occupancy,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 24 + hour(ts) AS BIGINT) AS ts
  FROM events)"""
MINUTES = """sensor AS (
  SELECT 'I' || CAST(101 + user_id % 3 AS VARCHAR) AS intersection_id,
         'I' || CAST(101 + user_id % 3 AS VARCHAR) || '_R' || CAST(1 + user_id % 4 AS VARCHAR) AS road_id,
         CAST(value AS DECIMAL(18,3)) AS avg_speed,
         CAST((date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 24 + hour(ts)) * 60 + minute(ts) AS BIGINT) AS ts
  FROM events)"""
EVENT = """event AS (
  SELECT 'EVT_' || CASE WHEN length(CAST(event_id AS VARCHAR)) < 6
                        THEN lpad(CAST(event_id AS VARCHAR), 6, '0') ELSE CAST(event_id AS VARCHAR) END AS event_id,
         event_type,
         'I' || CAST(101 + user_id % 3 AS VARCHAR) AS intersection_id,
         'I' || CAST(101 + user_id % 3 AS VARCHAR) || '_R' || CAST(1 + user_id % 4 AS VARCHAR) AS road_id,
         CAST(1 + event_id % 3 AS BIGINT) AS priority,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 24 + hour(ts) AS BIGINT) AS ts
  FROM events)"""
COMMAND = """command AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS cmd_id, 'S' || CAST(o_custkey % 10 AS VARCHAR) AS signal_id,
         o_orderstatus AS action, CAST(floor(o_totalprice) AS BIGINT) AS duration, o_orderpriority AS reason,
         CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS ts
  FROM orders)"""
SHIP = """ship AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
         CAST(l_quantity AS DECIMAL(18,3)) AS l_quantity, CAST(l_extendedprice AS DECIMAL(18,3)) AS l_extendedprice,
         CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) AS ts
  FROM lineitem)"""

ORACLES: dict[str, str] = {}


def _sql(name: str, *ctes: str, select: str) -> None:
    ORACLES[name] = ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + select


SPEED = """CAST(sum(avg_speed) AS DOUBLE) AS s_spd, CAST(max(avg_speed) AS DOUBLE) AS x_spd,
  CAST(min(avg_speed) AS DOUBLE) AS n_spd, count(*) AS c_pkt"""
OCC = """CAST(sum(occupancy) AS DOUBLE) AS s_occ, CAST(max(occupancy) AS DOUBLE) AS x_occ,
  CAST(min(occupancy) AS DOUBLE) AS n_occ, count(*) AS c_pkt"""

# --- snapshots ---------------------------------------------------------------------------------

_sql("snap_rd_speed", SENSOR, select=f"""
SELECT road_id, intersection_id, {SPEED}, count(*) AS pkt_count,
  CAST(sum(avg_speed) AS DOUBLE) AS sum_speed, CAST(max(avg_speed) AS DOUBLE) AS max_speed,
  CAST(min(avg_speed) AS DOUBLE) AS min_speed, CAST(sum(avg_speed) AS DOUBLE) / count(*) AS avg_speed
FROM sensor GROUP BY road_id, intersection_id""")
_sql("snap_is_speed", SENSOR, select=f"""
SELECT intersection_id, {SPEED}, CAST(sum(avg_speed) AS DOUBLE) / count(*) AS avg_speed
FROM sensor GROUP BY intersection_id""")
_sql("snap_rd_occ", SENSOR, select=f"""
SELECT road_id, intersection_id, {OCC}, CAST(sum(occupancy) AS DOUBLE) AS sum_occupancy,
  CAST(max(occupancy) AS DOUBLE) AS max_occupancy, CAST(min(occupancy) AS DOUBLE) AS min_occupancy,
  CAST(sum(occupancy) AS DOUBLE) / count(*) AS avg_occupancy
FROM sensor GROUP BY road_id, intersection_id""")
_sql("snap_is_occ", SENSOR, select=f"""
SELECT intersection_id, {OCC}, CAST(sum(occupancy) AS DOUBLE) / count(*) AS avg_occupancy
FROM sensor GROUP BY intersection_id""")
_sql("snap_rd_veh", SENSOR, select="""
SELECT road_id, intersection_id, CAST(sum(vehicle_count) AS BIGINT) AS s_veh,
  CAST(sum(vehicle_count) AS BIGINT) AS total_vehicles FROM sensor GROUP BY road_id, intersection_id""")
_sql("snap_is_veh", SENSOR, select="""
SELECT intersection_id, CAST(sum(vehicle_count) AS BIGINT) AS s_veh FROM sensor GROUP BY intersection_id""")
_sql("snap_rd_evt", EVENT, select="""
SELECT road_id, intersection_id, event_type, count(*) AS c_evt, count(*) AS total_count
FROM event GROUP BY road_id, intersection_id, event_type""")
_sql("snap_is_evt", EVENT, select="""
SELECT intersection_id, event_type, count(*) AS c_evt FROM event GROUP BY intersection_id, event_type""")

# --- histories ---------------------------------------------------------------------------------

PARTS = """p AS (
  SELECT ts, road_id, intersection_id, sum(avg_speed) AS s, max(avg_speed) AS x, min(avg_speed) AS n, count(*) AS c
  FROM sensor GROUP BY ts, road_id, intersection_id)"""
GRID = """grid AS (
  SELECT t.ts, f.road_id, f.intersection_id FROM ticks t JOIN
    (SELECT road_id, intersection_id, min(ts) AS since FROM p GROUP BY road_id, intersection_id) f ON t.ts >= f.since)"""
TICKS = "ticks AS (SELECT DISTINCT ts FROM sensor)"
RUNNING = """CAST(sum(s) OVER w AS DOUBLE) AS s_spd, CAST(max(x) OVER w AS DOUBLE) AS x_spd,
  CAST(min(n) OVER w AS DOUBLE) AS n_spd, CAST(sum(c) OVER w AS BIGINT) AS c_pkt"""
TARGETS = """CAST(sum(c) OVER w AS BIGINT) AS pkt_count, CAST(sum(s) OVER w AS DOUBLE) AS sum_speed,
  CAST(max(x) OVER w AS DOUBLE) AS max_speed, CAST(min(n) OVER w AS DOUBLE) AS min_speed,
  CAST(sum(s) OVER w AS DOUBLE) / CAST(sum(c) OVER w AS BIGINT) AS avg_speed"""
ROAD_W = "WINDOW w AS (PARTITION BY road_id, intersection_id ORDER BY ts ROWS UNBOUNDED PRECEDING)"

_sql("hist_rd_speed_dense", SENSOR, TICKS, PARTS, GRID, select=f"""
SELECT ts, road_id, intersection_id, {RUNNING}, {TARGETS}
FROM grid LEFT JOIN p USING (ts, road_id, intersection_id) {ROAD_W}""")
_sql("hist_rd_speed_sparse", SENSOR, PARTS, select=f"""
SELECT ts, road_id, intersection_id, {RUNNING}, {TARGETS} FROM p {ROAD_W}""")
_sql("hist_none_latest", SENSOR, TICKS, PARTS, GRID, select="""
SELECT ts, road_id, intersection_id, CAST(last_value(x IGNORE NULLS) OVER w AS DOUBLE) AS v_spd,
  CAST(sum(s) OVER w AS DOUBLE) / CAST(sum(c) OVER w AS BIGINT) AS a_spd, CAST(sum(c) OVER w AS BIGINT) AS c_pkt
FROM grid LEFT JOIN p USING (ts, road_id, intersection_id) """ + ROAD_W)
_sql("snap_none_latest", SENSOR, PARTS, select="""
SELECT road_id, intersection_id, CAST(arg_max(x, ts) AS DOUBLE) AS v_spd, CAST(sum(c) AS BIGINT) AS c_pkt
FROM p GROUP BY road_id, intersection_id""")
def _walk(frequency: int) -> str:
    return f"""walk AS (
  SELECT min(ts) AS ts FROM everything
  UNION ALL
  SELECT (SELECT min(t.ts) FROM alltimes t WHERE t.ts >= walk.ts + {frequency}) AS ts FROM walk
  WHERE walk.ts + {frequency} <= (SELECT max(ts) FROM alltimes))"""


def _due_sql(name: str, frequency: int, *ctes: str, select: str) -> None:
    """SQL over ``ticks``, the due ticks of the hourly sensor stream ``everything``."""
    ORACLES[name] = "WITH RECURSIVE " + ",\n".join([
        SENSOR.replace("sensor AS", "everything AS"),
        "alltimes AS (SELECT DISTINCT ts FROM everything)", _walk(frequency),
        "ticks AS (SELECT ts FROM walk WHERE ts IS NOT NULL)", *ctes,
    ]) + "\n" + select


_due_sql("hist_freq5", 5, "sensor AS (SELECT * FROM everything WHERE ts IN (SELECT ts FROM ticks))",
         PARTS, GRID, select=f"""
SELECT ts, road_id, intersection_id, {RUNNING}
FROM grid LEFT JOIN p USING (ts, road_id, intersection_id) {ROAD_W}""")

GAPPY = [MINUTES.replace("sensor AS", "everything AS"), "alltimes AS (SELECT DISTINCT ts FROM everything)"]
ORACLES["due_ticks_gappy"] = (
    "WITH RECURSIVE " + ",\n".join([*GAPPY, _walk(3)]) + "\nSELECT ts FROM walk WHERE ts IS NOT NULL"
)
ORACLES["hist_gappy_freq30"] = "WITH RECURSIVE " + ",\n".join([
    *GAPPY, _walk(30), "sensor AS (SELECT * FROM everything WHERE ts IN (SELECT ts FROM walk))", PARTS,
]) + f"\nSELECT ts, road_id, intersection_id, {RUNNING} FROM p {ROAD_W}"

IS_PARTS = """p AS (
  SELECT ts, intersection_id, sum(avg_speed) AS s, max(avg_speed) AS x, min(avg_speed) AS n, count(*) AS c
  FROM sensor GROUP BY ts, intersection_id)"""
IS_GRID = """grid AS (
  SELECT t.ts, f.intersection_id FROM ticks t JOIN
    (SELECT intersection_id, min(ts) AS since FROM p GROUP BY intersection_id) f ON t.ts >= f.since)"""
IS_W = "WINDOW w AS (PARTITION BY intersection_id ORDER BY ts ROWS UNBOUNDED PRECEDING)"
_sql("hist_skip_tick_zero", SENSOR.replace("sensor AS", "everything AS"),
     "sensor AS (SELECT * FROM everything WHERE ts > 0)", TICKS, IS_PARTS, IS_GRID, select=f"""
SELECT ts, intersection_id, {RUNNING} FROM grid LEFT JOIN p USING (ts, intersection_id) {IS_W}""")
_sql("hist_shared_clock", EVENT, COMMAND,
     "ticks AS (SELECT ts FROM event UNION SELECT ts FROM command)",
     """p AS (SELECT ts, road_id, intersection_id, event_type, count(*) AS c FROM event
  GROUP BY ts, road_id, intersection_id, event_type)""",
     """grid AS (SELECT t.ts, f.* EXCLUDE (since) FROM ticks t JOIN
  (SELECT road_id, intersection_id, event_type, min(ts) AS since FROM p GROUP BY ALL) f ON t.ts >= f.since)""",
     select="""
SELECT ts, road_id, intersection_id, event_type, CAST(sum(c) OVER w AS BIGINT) AS c_evt,
  CAST(sum(c) OVER w AS BIGINT) AS total_count
FROM grid LEFT JOIN p USING (ts, road_id, intersection_id, event_type)
WINDOW w AS (PARTITION BY road_id, intersection_id, event_type ORDER BY ts ROWS UNBOUNDED PRECEDING)""")
_sql("hist_global", EVENT, COMMAND,
     "ticks AS (SELECT ts FROM event UNION SELECT ts FROM command)",
     """p AS (SELECT ts, sum(duration) AS s, count(duration) AS c, max(duration) AS x FROM command
  WHERE action = 'P' GROUP BY ts)""", select="""
SELECT ts, CAST(coalesce(sum(s) OVER w, 0) AS BIGINT) AS s_dur,
  coalesce(CAST(sum(s) OVER w AS DOUBLE) / CAST(sum(c) OVER w AS BIGINT), 0) AS a_dur,
  CAST(coalesce(sum(c) OVER w, 0) AS BIGINT) AS c_cmd, max(x) OVER w AS x_dur
FROM ticks LEFT JOIN p USING (ts) WINDOW w AS (ORDER BY ts ROWS UNBOUNDED PRECEDING)""")
_sql("hist_shipments_sparse", SHIP,
     """p AS (SELECT ts, l_returnflag, l_linestatus, sum(l_quantity) AS q, sum(l_extendedprice) AS s,
  max(l_extendedprice) AS x, min(l_extendedprice) AS n, count(*) AS c FROM ship
  GROUP BY ts, l_returnflag, l_linestatus)""", select="""
SELECT ts, l_returnflag, l_linestatus, CAST(sum(q) OVER w AS DOUBLE) AS s_qty,
  CAST(sum(s) OVER w AS DOUBLE) / CAST(sum(c) OVER w AS BIGINT) AS a_price,
  CAST(max(x) OVER w AS DOUBLE) AS x_price, CAST(min(n) OVER w AS DOUBLE) AS n_price,
  CAST(sum(c) OVER w AS BIGINT) AS c_all
FROM p WINDOW w AS (PARTITION BY l_returnflag, l_linestatus ORDER BY ts ROWS UNBOUNDED PRECEDING)""")
_sql("hist_by_text", EVENT,
     """p AS (SELECT ts, intersection_id, max(event_type) AS x, min(event_type) AS n, count(event_type) AS c
  FROM event GROUP BY ts, intersection_id)""", select=f"""
SELECT ts, intersection_id, max(x) OVER w AS x_type, min(n) OVER w AS n_type, CAST(sum(c) OVER w AS BIGINT) AS c_type
FROM p {IS_W}""")

# --- filters on the current tick: rows that pass, per due tick ----------------------------------


def _at_ticks(condition: str) -> str:
    return f"""r AS (SELECT t.ts AS tick, s.* FROM ticks t JOIN sensor s ON s.ts <= t.ts AND {condition})"""


def _tick_sql(name: str, condition: str) -> None:
    _sql(name, SENSOR, TICKS, _at_ticks(condition), select=f"""
SELECT tick AS ts, intersection_id, {SPEED} FROM r GROUP BY tick, intersection_id""")


_tick_sql("tick_lt", "s.ts < t.ts")
_tick_sql("tick_ge", "s.ts >= t.ts")
_tick_sql("tick_ne", "s.ts <> t.ts")
_tick_sql("tick_gt", "s.ts > t.ts")
_tick_sql("tick_lt_sliding", "s.ts < t.ts AND s.ts >= t.ts - 5")
_tick_sql("field_le_tick", "s.vehicle_count <= t.ts")
_tick_sql("field_ge_tick", "s.vehicle_count >= t.ts")
_tick_sql("field_ne_tick", "s.vehicle_count <> t.ts")
_sql("hist_tick_le", SENSOR, TICKS, _at_ticks("s.ts <= t.ts"),
     """p AS (SELECT tick AS ts, intersection_id, sum(avg_speed) AS s, max(avg_speed) AS x, min(avg_speed) AS n,
  count(*) AS c FROM r GROUP BY tick, intersection_id)""", select=f"""
SELECT ts, intersection_id, {RUNNING} FROM p {IS_W}""")

# --- aggregates and filters ---------------------------------------------------------------------

_sql("global_agg", SENSOR, select=f"""
SELECT {SPEED}, CAST(sum(avg_speed) AS DOUBLE) / count(avg_speed) AS a_spd, count(vehicle_count) AS c_veh,
  CAST(sum(vehicle_count) AS BIGINT) AS s_veh FROM sensor""")


def _filter_sql(name: str, condition: str) -> None:
    _sql(name, SENSOR, select=f"""
SELECT road_id, intersection_id, {SPEED} FROM sensor WHERE {condition} GROUP BY road_id, intersection_id""")


_filter_sql("filter_eq", "road_id = 'I101_R2'")
_filter_sql("filter_eq_decimal", "avg_speed = 12.31")
_filter_sql("filter_ne", "road_id <> 'I101_R2'")
_filter_sql("filter_ltgt", "vehicle_count <> 30")
_filter_sql("filter_gt", "avg_speed > 39.6")
_filter_sql("filter_ge", "vehicle_count >= 50")
_filter_sql("filter_lt", "vehicle_count < 49.5")
_filter_sql("filter_le", "occupancy <= 10")
_filter_sql("filter_and", "vehicle_count > 20 AND avg_speed < 50 AND intersection_id = 'I102'")
_filter_sql("filter_null", "road_id = NULL")
_due_sql("filter_none", 100, "sensor AS (SELECT * FROM everything)", _at_ticks("true"), select=f"""
SELECT tick AS ts, road_id, intersection_id, {SPEED} FROM r GROUP BY tick, road_id, intersection_id""")
_sql("result_filter", SENSOR, PARTS, select=f"""
SELECT * FROM (SELECT ts, road_id, intersection_id, {RUNNING} FROM p {ROAD_W}) WHERE c_pkt = 5""")

# --- summary updates, derived metrics, stored fields ---------------------------------------------

_sql("summary_updates", SENSOR, PARTS, select="""
SELECT road_id, intersection_id, CAST(sum(s) AS DOUBLE) AS s_spd, CAST(max(x) AS DOUBLE) AS x_spd,
  CAST(sum(c) AS BIGINT) AS c_pkt, CAST(sum(s) AS DOUBLE) AS sum_speed, CAST(max(x) AS DOUBLE) AS max_speed,
  max(c) AS busiest, min(c) AS quietest, arg_max(c, ts) AS last_count, CAST(sum(x) AS DOUBLE) AS peak_total
FROM p GROUP BY road_id, intersection_id""")
IS_OCC = """p AS (
  SELECT ts, intersection_id, sum(occupancy) AS s, max(occupancy) AS x, min(occupancy) AS n, count(*) AS c
  FROM sensor GROUP BY ts, intersection_id)"""
OCC_RUNNING = """CAST(sum(s) OVER w AS DOUBLE) AS s_occ, CAST(max(x) OVER w AS DOUBLE) AS x_occ,
  CAST(min(n) OVER w AS DOUBLE) AS n_occ, CAST(sum(c) OVER w AS BIGINT) AS c_pkt"""
_sql("derived_metrics", SENSOR, IS_OCC, select=f"""
SELECT ts, intersection_id, {OCC_RUNNING},
  CAST(sum(s) OVER w AS DOUBLE) / CAST(sum(c) OVER w AS BIGINT) AS avg_occ FROM p {IS_W}""")
_sql("store_fields", SENSOR, IS_OCC, select=f"SELECT ts, intersection_id, {OCC_RUNNING} FROM p {IS_W}")
_sql("standard_names", SENSOR, select="""
SELECT road_id, intersection_id, CAST(sum(avg_speed) AS DOUBLE) / count(avg_speed) AS avg_speed_avg,
  count(*) AS all_count FROM sensor GROUP BY road_id, intersection_id""")

# --- one tick at a time --------------------------------------------------------------------------

_sql("tick_result", SENSOR, select=f"""
SELECT road_id, intersection_id, {SPEED}, CAST(sum(avg_speed) AS DOUBLE) / count(avg_speed) AS a_spd
FROM sensor WHERE ts = (SELECT max(ts) FROM sensor) GROUP BY road_id, intersection_id""")
_sql("tick_result_retained", SENSOR, """held AS (
  SELECT * FROM sensor WHERE ts <= (SELECT max(ts) FROM sensor) - 24 ORDER BY ts DESC, pkt_id DESC LIMIT 77)""",
     select="""
SELECT intersection_id, CAST(sum(avg_speed) AS DOUBLE) AS s_spd,
  CAST(sum(avg_speed) AS DOUBLE) / count(avg_speed) AS a_spd, count(avg_speed) AS __count_a_spd
FROM held GROUP BY intersection_id""")
_sql("merge_snapshots", SENSOR, PARTS, "cut AS (SELECT floor(max(ts) / 2) AS half FROM sensor)",
     "sides AS (SELECT *, ts > (SELECT half FROM cut) AS newer FROM p)",
     """halves AS (SELECT road_id, intersection_id, newer, sum(s) AS s, max(x) AS x, min(n) AS n, sum(c) AS c,
  arg_max(x, ts) AS v FROM sides GROUP BY road_id, intersection_id, newer)""", select="""
SELECT road_id, intersection_id, CAST(sum(s) AS DOUBLE) AS s_spd, CAST(max(x) AS DOUBLE) AS x_spd,
  CAST(min(n) AS DOUBLE) AS n_spd, CAST(sum(c) AS BIGINT) AS c_pkt,
  round(CAST(sum(s) AS DOUBLE) / CAST(sum(c) AS BIGINT), 6) AS a_spd,
  CAST(arg_max(v, newer) AS DOUBLE) AS v_spd,
  max(CASE WHEN newer THEN 'second half' END) AS note
FROM halves GROUP BY road_id, intersection_id""")

# --- long-format metrics ---------------------------------------------------------------------------

LONG = """d AS (
  SELECT 'road_id' AS field, road_id AS field_value, * FROM sensor
  UNION ALL SELECT 'intersection_id', intersection_id, * FROM sensor)""", """p AS (
  SELECT ts, field, field_value, sum(avg_speed) AS s, count(avg_speed) AS n, sum(vehicle_count) AS v,
    min(occupancy) AS o, max(vehicle_count) AS l, count(*) AS c
  FROM d GROUP BY ts, field, field_value)""", """m AS (
  SELECT ts, field, field_value, CAST(sum(s) OVER w AS DOUBLE) / CAST(sum(n) OVER w AS BIGINT) AS a,
    CAST(sum(n) OVER w AS DOUBLE) AS h, CAST(sum(v) OVER w AS DOUBLE) AS v, CAST(min(o) OVER w AS DOUBLE) AS o,
    CAST(l AS DOUBLE) AS l, CAST(sum(c) OVER w AS DOUBLE) AS c
  FROM p WINDOW w AS (PARTITION BY field, field_value ORDER BY ts ROWS UNBOUNDED PRECEDING))""", """rows_ AS (
  SELECT ts, field, field_value, 'speed' AS metric, 'avg' AS aggregate, a AS value, h AS helper_count FROM m
  UNION ALL SELECT ts, field, field_value, 'vehicle_count', 'sum', v, 0 FROM m
  UNION ALL SELECT ts, field, field_value, 'occupancy', 'min', o, 0 FROM m
  UNION ALL SELECT ts, field, field_value, 'vehicle_count', 'none', l, 1 FROM m
  UNION ALL SELECT ts, field, field_value, '*', 'count', c, 0 FROM m)"""
_sql("metrics_long_changed", SENSOR, *LONG, select="""
SELECT ts, field, field_value, metric, aggregate, value FROM rows_""")
KEY_TEXT = """'{"field":"' || field || '","field_value":"' || field_value || '"}'"""
_sql("metrics_long_summary", SENSOR, *LONG, select=f"""
SELECT 'sensor_stream' AS stream_name, metric AS metric_field, aggregate AS aggregate_name, {KEY_TEXT} AS dimensions,
  value, CAST(helper_count AS DOUBLE) AS helper_count, ts AS last_updated_tick
FROM (SELECT *, row_number() OVER (PARTITION BY field, field_value, metric, aggregate ORDER BY ts DESC) AS k FROM rows_)
WHERE k = 1""")
EVENT_LONG = """d AS (
  SELECT 'road_id' AS field, road_id AS field_value, * FROM event
  UNION ALL SELECT 'intersection_id', intersection_id, * FROM event)""", """p AS (
  SELECT ts, field, field_value, count(event_type) AS c, max(priority) AS x FROM d GROUP BY ts, field, field_value)""", """m AS (
  SELECT ts, field, field_value, CAST(sum(c) OVER w AS DOUBLE) AS c, CAST(max(x) OVER w AS DOUBLE) AS x
  FROM p WINDOW w AS (PARTITION BY field, field_value ORDER BY ts ROWS UNBOUNDED PRECEDING))""", """rows_ AS (
  SELECT ts, field, field_value, 'event_type' AS metric, 'count' AS aggregate, c AS value FROM m
  UNION ALL SELECT ts, field, field_value, 'priority', 'max', x FROM m)"""
_sql("metrics_long_events", EVENT, *EVENT_LONG, select="SELECT * FROM rows_")
_sql("metrics_long_fallback", EVENT, COMMAND, *EVENT_LONG,
     """idle AS (SELECT DISTINCT ts AS tick FROM command WHERE ts NOT IN (SELECT ts FROM event))""",
     """seen AS (SELECT i.tick, r.*, row_number() OVER (
    PARTITION BY i.tick, field, field_value, metric, aggregate ORDER BY r.ts DESC) AS k
  FROM idle i JOIN rows_ r ON r.ts <= i.tick)""", select="""
SELECT * FROM rows_ UNION ALL SELECT tick AS ts, field, field_value, metric, aggregate, value FROM seen WHERE k = 1""")
SENSOR_SUMMARY = """summary AS (
  SELECT 'sensor_stream' AS stream_name, 'speed' AS metric_field, 'avg' AS aggregate_name,
    '{"field":"' || field || '","field_value":"' || field_value || '"}' AS dimensions,
    CAST(sum(avg_speed) AS DOUBLE) / count(avg_speed) AS value, CAST(count(avg_speed) AS DOUBLE) AS helper_count,
    max(ts) AS last_updated_tick
  FROM (SELECT 'road_id' AS field, road_id AS field_value, * FROM sensor
        UNION ALL SELECT 'intersection_id', intersection_id, * FROM sensor) GROUP BY field, field_value)"""
_sql("summary_lookup", SENSOR, SENSOR_SUMMARY, select="SELECT * FROM summary")

# --- retention and windows --------------------------------------------------------------------------

SENSOR_ALL = """pkt_id, intersection_id, road_id, signal_id, CAST(vehicle_count AS BIGINT) AS vehicle_count,
  CAST(avg_speed AS DOUBLE) AS avg_speed, CAST(occupancy AS DOUBLE) AS occupancy, ts"""
_sql("retain_sliding_seconds", SENSOR, select=f"""
SELECT {SENSOR_ALL} FROM sensor WHERE ts >= (SELECT max(ts) FROM sensor) - 5""")
_sql("retain_sliding_rows", SENSOR, select=f"""
SELECT {SENSOR_ALL} FROM sensor ORDER BY sensor.ts DESC, pkt_id DESC LIMIT 137""")
_sql("retain_tumbling_seconds", EVENT, select="SELECT * FROM event WHERE ts >= (SELECT max(ts) FROM event) - 24")
_sql("retain_tumbling_rows", EVENT, select="SELECT * FROM event ORDER BY ts DESC, event_id DESC LIMIT 10")
_sql("retain_landmark", COMMAND, select="SELECT * FROM command")
_sql("retain_unknown_unit", COMMAND, select="SELECT * FROM command")
_sql("retain_rows_cutoff", COMMAND, select="SELECT * FROM command ORDER BY ts DESC, cmd_id DESC LIMIT 1234")
_sql("evicted_rows", SENSOR, select="""
SELECT pkt_id, ts FROM sensor WHERE ts < (SELECT max(ts) FROM sensor) - 100""")

ROAD_SPEED = f"""{SPEED}, CAST(sum(avg_speed) AS DOUBLE) / count(avg_speed) AS a_spd"""


def _retained_sql(name: str, condition: str) -> None:
    _sql(name, SENSOR, TICKS, _at_ticks(condition), select=f"""
SELECT tick AS ts, road_id, {ROAD_SPEED} FROM r GROUP BY tick, road_id""")


_retained_sql("query_sliding_seconds", "s.ts >= t.ts - 5")
_retained_sql("query_landmark", "true")
_due_sql("query_sliding_seconds_freq", 7, "sensor AS (SELECT * FROM everything)", _at_ticks("s.ts >= t.ts - 40"),
         select=f"SELECT tick AS ts, road_id, {ROAD_SPEED} FROM r GROUP BY tick, road_id")
_sql("query_sliding_seconds_merged", SENSOR, TICKS, _at_ticks("s.ts >= t.ts - 5"),
     """p AS (SELECT tick AS ts, road_id, sum(avg_speed) AS s, max(avg_speed) AS x, min(avg_speed) AS n, count(*) AS c
  FROM r GROUP BY tick, road_id)""",
     """grid AS (SELECT t.ts, f.road_id FROM ticks t JOIN
  (SELECT road_id, min(ts) AS since FROM p GROUP BY road_id) f ON t.ts >= f.since)""", select=f"""
SELECT ts, road_id, {RUNNING}, CAST(sum(s) OVER w AS DOUBLE) / CAST(sum(c) OVER w AS BIGINT) AS a_spd
FROM grid LEFT JOIN p USING (ts, road_id)
WINDOW w AS (PARTITION BY road_id ORDER BY ts ROWS UNBOUNDED PRECEDING)""")
RANKED = """ranked AS (SELECT *, row_number() OVER (ORDER BY ts, pkt_id) AS pos FROM sensor)"""
ENDS = """ends AS (SELECT ts AS tick, max(pos) AS top FROM ranked GROUP BY ts)"""
_sql("query_sliding_rows", SENSOR, RANKED, ENDS,
     "r AS (SELECT e.tick, k.* FROM ends e JOIN ranked k ON k.pos > e.top - 50 AND k.pos <= e.top)", select=f"""
SELECT tick AS ts, road_id, {ROAD_SPEED} FROM r GROUP BY tick, road_id""")
_sql("stored_history_retry", SENSOR, select="""
SELECT ts, count(DISTINCT road_id) AS groups FROM sensor
WHERE ts < 500 AND ts >= (SELECT max(ts) FROM sensor WHERE ts < 500) - 100 GROUP BY ts""")
ORACLES["stream_row_window"] = ORACLES["query_sliding_rows"]
_sql("query_rows_at_tick", SENSOR, RANKED, ENDS,
     "r AS (SELECT e.tick, k.* FROM ends e JOIN ranked k ON k.pos > e.top - 4 AND k.pos <= e.top AND k.ts = e.tick)",
     select="""
SELECT tick AS ts, intersection_id, CAST(sum(avg_speed) AS DOUBLE) AS s_spd, count(*) AS c_pkt
FROM r GROUP BY tick, intersection_id""")

ALIGNED = """CAST(sum(avg_speed) AS DOUBLE) AS s_spd, CAST(max(avg_speed) AS DOUBLE) AS x_spd, count(*) AS c_pkt"""


def _windows_sql(name: str, size: int, slide: int) -> None:
    _sql(name, SENSOR,
         f"starts AS (SELECT CAST(range AS BIGINT) AS window_start FROM range(-{size // slide * slide}, 800, {slide}))",
         select=f"""
SELECT window_start, road_id, {ALIGNED} FROM starts JOIN sensor
  ON sensor.ts >= window_start AND sensor.ts < window_start + {size} GROUP BY window_start, road_id""")


_windows_sql("window_tumbling_aligned", 24, 24)
_windows_sql("window_sliding_aligned", 24, 6)
_windows_sql("window_slide_gaps", 5, 10)
_sql("window_rows_aligned", SENSOR, RANKED, select=f"""
SELECT CAST((pos - 1) // 100 * 100 AS BIGINT) AS window_start, road_id, {ALIGNED}
FROM ranked GROUP BY 1, road_id""")

# --- tables -----------------------------------------------------------------------------------------

_sql("top1000_sensor", SENSOR, select="""
SELECT pkt_id, ts, intersection_id, road_id, CAST(avg_speed AS DOUBLE) AS speed, CAST(occupancy AS DOUBLE) AS occupancy
FROM sensor ORDER BY sensor.ts DESC, pkt_id LIMIT 1000""")
_sql("top1000_event", EVENT, select="""
SELECT event_id AS evt_id, ts, road_id, event_type FROM event ORDER BY event.ts DESC, event_id LIMIT 1000""")
_sql("top1000_command", COMMAND, select="""
SELECT cmd_id, ts, signal_id AS intersection_id, action, reason FROM command
ORDER BY command.ts DESC, cmd_id LIMIT 1000""")
_sql("dedup_first_wins", SHIP, select="""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
  CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice, ts
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY ts, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus) AS k FROM ship)
WHERE k = 1""")
_sql("payload_copies", select="""
SELECT digest, doc_id AS path FROM (
  SELECT md5(text) AS digest, doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY n_chars, doc_id) AS k
  FROM documents) WHERE k = 1""")
_sql("table_counts", select="""
SELECT 'sensor_stream' AS table_name, count(*) AS row_count FROM events
UNION ALL SELECT 'event_stream', count(*) FROM events UNION ALL SELECT 'command_stream', count(*) FROM orders""")
_sql("reset_audit", SENSOR, SENSOR_SUMMARY, select="""
SELECT (SELECT count(*) FROM events) AS sensor_stream_count, (SELECT count(*) FROM events) AS event_stream_count,
  (SELECT count(*) FROM orders) AS command_stream_count, (SELECT count(*) FROM summary) AS summary_count,
  (SELECT max(ts) FROM sensor) AS current_tick,
  (SELECT count(*) FROM events) + (SELECT count(*) FROM orders) = 0 AS all_cleared""")
_sql("summary_upsert", SENSOR, SENSOR_SUMMARY, select="SELECT * FROM summary")
_sql("catalogue_upsert",
     """new_ AS (SELECT o_custkey, max(o_orderpriority) AS d, min(o_orderpriority) AS q FROM orders GROUP BY o_custkey)""",
     """old_ AS (SELECT c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS q FROM customer)""",
     select="""
SELECT coalesce(c_custkey, o_custkey) AS c_custkey,
  CASE WHEN o_custkey IS NOT NULL THEN d ELSE c_name END AS description, coalesce(old_.q, new_.q) AS query_config
FROM old_ FULL OUTER JOIN new_ ON c_custkey = o_custkey""")
_sql("schema_evolve", EVENT, COMMAND, select="""
SELECT event_id, event_type, ts, CAST(NULL AS BIGINT) AS duration FROM event
UNION ALL SELECT cmd_id, NULL, ts, duration FROM command""")
_sql("invalidate_history", SENSOR, select="""
SELECT 'IS-VEH-PKT' AS query_id, ts FROM (SELECT DISTINCT ts, intersection_id FROM sensor)""")
_sql("invalidate_summary", EVENT, *EVENT_LONG, select=f"""
SELECT 'event_stream' AS stream_name, metric AS metric_field, aggregate AS aggregate_name, {KEY_TEXT} AS dimensions,
  value, CAST(0 AS DOUBLE) AS helper_count, ts AS last_updated_tick
FROM (SELECT *, row_number() OVER (PARTITION BY field, field_value, metric, aggregate ORDER BY ts DESC) AS k FROM rows_)
WHERE k = 1""")
DIMS = """known AS (
  SELECT road_id, intersection_id FROM sensor GROUP BY road_id, intersection_id
  HAVING count(*) >= (SELECT count(*) / CAST(count(DISTINCT road_id) AS DOUBLE) FROM sensor))""", """signals AS (
  SELECT DISTINCT signal_id, road_id, intersection_id FROM sensor)""", """lost AS (
  SELECT * FROM signals s WHERE NOT EXISTS (
    SELECT 1 FROM known k WHERE k.road_id = s.road_id AND k.intersection_id = s.intersection_id))"""
_sql("orphan_rows", SENSOR, *DIMS, select="SELECT * FROM lost")
_sql("orphan_dims", SENSOR, *DIMS, select="""
SELECT 'road' AS table_name, 'intersection' AS parent_name, 'intersection_id' AS key_columns, CAST(0 AS BIGINT) AS orphan_count
UNION ALL SELECT 'traffic_signal', 'intersection', 'intersection_id', 0
UNION ALL SELECT 'traffic_signal', 'road', 'road_id,intersection_id', (SELECT count(*) FROM lost)
UNION ALL SELECT 'signal_group', 'traffic_signal', 'signal_id', 0""")

# --- logical time -----------------------------------------------------------------------------------

_sql("current_tick", COMMAND, select="SELECT max(ts) AS current_tick FROM command")
_sql("clock_after_batches", SHIP,
     """marked AS (SELECT l_partkey AS batch, ts,
  l_partkey = min(l_partkey) OVER (PARTITION BY l_orderkey, l_linenumber) AS is_new FROM ship)""", select="""
SELECT batch, max(ts) AS tick FROM marked GROUP BY batch HAVING bool_or(is_new)""")
_sql("raw_sql", SENSOR, select="""
SELECT road_id, count(*) AS c_pkt, CAST(max(avg_speed) AS DOUBLE) AS x_spd FROM sensor
WHERE ts > (SELECT max(ts) FROM sensor) - 48 GROUP BY road_id""")

# --- result history and series ------------------------------------------------------------------------

DENSE = f"""h AS (
  SELECT ts, road_id, intersection_id, {RUNNING},
    CAST(sum(s) OVER w AS DOUBLE) / CAST(sum(c) OVER w AS BIGINT) AS avg_speed
  FROM grid LEFT JOIN p USING (ts, road_id, intersection_id) {ROAD_W})"""
HISTORY = (SENSOR, TICKS, PARTS, GRID, DENSE)
_sql("history_json", *HISTORY, select="""
SELECT 'RD-SPEED-PKT' AS query_id, ts, road_id, intersection_id, s_spd, c_pkt, avg_speed FROM h""")
_sql("history_parsed", *HISTORY, select="""
SELECT 'RD-SPEED-PKT' AS query_id, ts, count(*) AS objects FROM h GROUP BY ts""")
_sql("latest_snapshot", *HISTORY, select="""
SELECT ts, road_id, x_spd, c_pkt FROM h WHERE ts = (SELECT max(ts) FROM h)""")
_sql("last_tick_of_query", *HISTORY, select="SELECT 'RD-SPEED-PKT' AS query_id, max(ts) AS last_ts FROM h")
_sql("series_wide", *HISTORY, select="""
SELECT ts, avg_speed AS value FROM h
WHERE road_id = 'I102_R3' AND ts >= greatest((SELECT max(ts) FROM h) - 100, 0)""")
_sql("series_fields", select="""
SELECT unnest(['road_id', 'intersection_id', 's_spd', 'x_spd', 'n_spd', 'c_pkt', 'pkt_count', 'sum_speed',
  'max_speed', 'min_speed', 'avg_speed']) AS field WHERE (SELECT count(*) FROM events) > 0""")
_sql("series_long", SENSOR, *LONG, "c1 AS (SELECT * FROM rows_ WHERE field = 'road_id' AND metric = 'speed' AND aggregate = 'avg' AND field_value = 'I102_R3')",
     select="SELECT DISTINCT ts, value FROM c1 WHERE ts >= (SELECT max(ts) FROM c1) - 200")
_sql("series_available", SENSOR, *LONG, select="SELECT DISTINCT field, field_value, metric, aggregate FROM rows_")
_sql("series_available_top", SENSOR, *LONG, select="""
SELECT DISTINCT field, field_value, metric, aggregate FROM rows_
ORDER BY field, field_value, metric, aggregate LIMIT 200""")
_sql("number_values", select="""
SELECT role, sum(coalesce(TRY_CAST(trim(text) AS DOUBLE), 0)) AS as_numbers,
  CAST(sum(turn) AS DOUBLE) AS turns, count(*) AS n FROM conversations GROUP BY role""")
_sql("display_values", SENSOR, select="""
SELECT lower(intersection_id) AS low, intersection_id AS title, CAST(round(sum(occupancy), 1) AS DOUBLE) AS s1,
  CAST(round(max(occupancy), 2) AS DOUBLE) AS x2, CAST(count(*) AS VARCHAR) AS c_text
FROM sensor GROUP BY intersection_id""")

# --- record files and streams -------------------------------------------------------------------------

_sql("xml_ingest_sensor", SENSOR, select=f"SELECT {SENSOR_ALL} FROM sensor")
_sql("xml_ingest_event", EVENT, select="SELECT * FROM event")
_sql("xml_ingest_command", COMMAND, select="SELECT * FROM command")
SPOILED = """spoiled AS (
  SELECT DISTINCT ts // 24 AS day FROM sensor WHERE ts // 24 % 5 = 0 AND vehicle_count = 7)"""
_sql("xml_reject_file", SENSOR, SPOILED, select=f"""
SELECT {SENSOR_ALL} FROM sensor WHERE ts // 24 NOT IN (SELECT day FROM spoiled)""")
_sql("xml_quarantine", SENSOR, SPOILED, select="""
SELECT count(DISTINCT ts // 24) AS files, count(*) AS records,
  count(CASE WHEN vehicle_count = 7 THEN 1 END) AS bad_records
FROM sensor WHERE ts // 24 IN (SELECT day FROM spoiled)""")
_sql("xml_same_payload", SENSOR, SPOILED, select="""
SELECT count(*) FILTER (k = 0) AS taken_records, max(ts) FILTER (k = 0) AS newest_tick,
  count(DISTINCT ts // 24) FILTER (k = 1) AS refused_files, count(*) FILTER (k = 1) AS refused_records,
  count(*) FILTER (k = 1 AND vehicle_count = 7) AS bad_records
FROM (SELECT ts, vehicle_count, CAST(ts // 24 IN (SELECT day FROM spoiled) AS INTEGER) AS k FROM sensor)""")
_sql("xml_query", EVENT, "ticks AS (SELECT DISTINCT ts FROM event)",
     "p AS (SELECT ts, intersection_id, event_type, count(*) AS c FROM event GROUP BY ALL)",
     """grid AS (SELECT t.ts, f.* EXCLUDE (since) FROM ticks t JOIN
  (SELECT intersection_id, event_type, min(ts) AS since FROM p GROUP BY ALL) f ON t.ts >= f.since)""", select="""
SELECT ts, intersection_id, event_type, CAST(sum(c) OVER (
  PARTITION BY intersection_id, event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS BIGINT) AS c_evt
FROM grid LEFT JOIN p USING (ts, intersection_id, event_type)""")
_sql("stream_equals_batch", EVENT, "ticks AS (SELECT DISTINCT ts FROM event)",
     "p AS (SELECT ts, road_id, intersection_id, event_type, count(*) AS c FROM event GROUP BY ALL)",
     """grid AS (SELECT t.ts, f.* EXCLUDE (since) FROM ticks t JOIN
  (SELECT road_id, intersection_id, event_type, min(ts) AS since FROM p GROUP BY ALL) f ON t.ts >= f.since)""", select="""
SELECT ts, road_id, intersection_id, event_type, CAST(sum(c) OVER w AS BIGINT) AS c_evt,
  CAST(sum(c) OVER w AS BIGINT) AS total_count
FROM grid LEFT JOIN p USING (ts, road_id, intersection_id, event_type)
WINDOW w AS (PARTITION BY road_id, intersection_id, event_type ORDER BY ts ROWS UNBOUNDED PRECEDING)""")
ORACLES["stream_parts_history"] = ORACLES["hist_rd_speed_sparse"]
ORACLES["stream_snapshot"] = ORACLES["snap_is_speed"]
_sql("stream_windows", COMMAND, select="""
SELECT CAST(ts // 30 * 30 AS BIGINT) AS window_start, action, count(*) AS c_cmd, max(duration) AS x_dur
FROM command GROUP BY 1, action""")
ORACLES["stream_summary"] = ORACLES["stream_summary_runs"] = ORACLES["invalidate_summary"]
_sql("stored_window", SENSOR, select=f"""
SELECT {SENSOR_ALL} FROM sensor WHERE ts >= (SELECT max(ts) FROM sensor) - 20""")
_sql("stored_history", SENSOR, select="""
SELECT 'RD-VEH-PKT' AS query_id, ts, count(DISTINCT road_id) AS objects FROM sensor GROUP BY ts
UNION ALL SELECT 'IS-VEH-PKT', ts, count(DISTINCT intersection_id) FROM sensor GROUP BY ts""")

# --- added rows ---------------------------------------------------------------------------------------

for _name, _same in (
    ("stream_freq5", "hist_freq5"), ("stream_rd_occ", "snap_rd_occ"), ("series_wide_typed", "series_wide"),
    ("stream_shared_clock", "hist_shared_clock"), ("stream_metrics_history", "metrics_long_events"),
    ("series_long_typed", "series_long"), ("latest_snapshot_typed", "latest_snapshot"),
):
    ORACLES[_name] = ORACLES[_same]
_sql("retain_large_rows", SENSOR, select=f"""
SELECT {SENSOR_ALL} FROM sensor ORDER BY sensor.ts DESC, pkt_id DESC LIMIT 12000""")
_sql("retain_sliding_events", EVENT, select="SELECT * FROM event ORDER BY ts DESC, event_id DESC LIMIT 55")
_sql("retain_null_ticks", SENSOR, """partly AS (
  SELECT pkt_id, CASE WHEN CAST(right(pkt_id, 1) AS INT) % 2 = 0 THEN ts END AS ts FROM sensor)""", select="""
SELECT pkt_id, ts FROM partly ORDER BY ts DESC NULLS LAST, pkt_id DESC LIMIT (SELECT count(*) * 3 // 4 FROM sensor)""")
_sql("evicted_by_rows", SENSOR, select="""
SELECT pkt_id, ts FROM (SELECT pkt_id, ts, row_number() OVER (ORDER BY ts DESC, pkt_id DESC) AS n FROM sensor) WHERE n > 137""")
_sql("derived_nested", SENSOR, select="""
SELECT road_id, intersection_id, CAST(sum(avg_speed) AS DOUBLE) AS s_spd, CAST(max(avg_speed) AS DOUBLE) AS x_spd,
  count(*) AS c_pkt, CAST(NULL AS DOUBLE) AS zero, CAST(NULL AS DOUBLE) AS by_zero,
  -(CAST(max(avg_speed) AS DOUBLE) - CAST(sum(avg_speed) AS DOUBLE) / count(*)) * 2 / (CAST(max(avg_speed) AS DOUBLE) + 1.5) AS nested
FROM sensor GROUP BY road_id, intersection_id""")
_sql("field_lt_tick_large", SENSOR, select="""
SELECT t.ts, s.road_id, count(*) AS c_pkt FROM (SELECT DISTINCT ts FROM sensor) t
JOIN sensor s ON s.ts <= t.ts AND CAST(right(s.pkt_id, 1) AS INT) % 3 = 2 GROUP BY t.ts, s.road_id""")
ORACLES["metrics_default_dimensions"] = ORACLES["metrics_long_changed"]
_sql("series_old_shape", SENSOR, """p AS (
  SELECT ts, sum(avg_speed) AS s, count(avg_speed) AS c FROM sensor WHERE road_id = 'I102_R3' GROUP BY ts)""", """c1 AS (
  SELECT ts, CAST(sum(s) OVER w AS DOUBLE) / CAST(sum(c) OVER w AS BIGINT) AS value FROM p WINDOW w AS (ORDER BY ts))""",
     select="SELECT ts, value FROM c1 WHERE ts >= (SELECT max(ts) FROM c1) - 200")
_sql("object_lists", select="""
SELECT event_id, CAST(1 AS BIGINT) AS lone, CAST(0 AS BIGINT) AS garbage, CAST(2 AS BIGINT) AS listed,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
