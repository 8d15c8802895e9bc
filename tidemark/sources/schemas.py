"""Streams: their columns, primary keys and XML record names (fixed values)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _columns(**types) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in types.items()])


_TEXT, _INT, _REAL = StringType(), IntegerType(), DoubleType()


@dataclass(frozen=True)
class Stream:
    name: str
    key: str
    row_tag: str
    root_tag: str
    schema: StructType


SENSOR = Stream(
    "sensor_stream", "pkt_id", "sensor_event", "SensorStreamInput",
    _columns(
        pkt_id=_TEXT, intersection_id=_TEXT, road_id=_TEXT, signal_id=_TEXT,
        vehicle_count=_INT, avg_speed=_REAL, occupancy=_REAL, ts=_INT,
    ),
)
EVENT = Stream(
    "event_stream", "event_id", "event", "EventStreamInput",
    _columns(
        event_id=_TEXT, event_type=_TEXT, intersection_id=_TEXT, road_id=_TEXT,
        priority=_INT, ts=_INT,
    ),
)
COMMAND = Stream(
    "command_stream", "cmd_id", "command", "CommandStreamInput",
    _columns(cmd_id=_TEXT, signal_id=_TEXT, action=_TEXT, duration=_INT, reason=_TEXT, ts=_INT),
)
STREAMS = {s.name: s for s in (SENSOR, EVENT, COMMAND)}

HISTORY = _columns(id=LongType(), query_id=_TEXT, ts=LongType(), result=_TEXT)
SUMMARY = _columns(
    stream_name=_TEXT, metric_field=_TEXT, aggregate_name=_TEXT, dimensions=_TEXT,
    value=_REAL, helper_count=_REAL, last_updated_tick=_INT,
)
SUMMARY_KEY = ["stream_name", "metric_field", "aggregate_name", "dimensions"]

# dimension tables and their foreign keys: (table, columns, parent table)
DIMENSION_TABLES = {
    "intersection": _columns(intersection_id=_TEXT, location=_TEXT, num_roads=_INT),
    "road": _columns(road_id=_TEXT, intersection_id=_TEXT, direction=_TEXT, num_lanes=_INT),
    "traffic_signal": _columns(
        signal_id=_TEXT, intersection_id=_TEXT, road_id=_TEXT, current_state=_TEXT,
        last_updated=TimestampType(),
    ),
    "signal_group": _columns(group_id=_INT, signal_id=_TEXT),
}
FOREIGN_KEYS = (
    ("road", ("intersection_id",), "intersection"),
    ("traffic_signal", ("intersection_id",), "intersection"),
    ("traffic_signal", ("road_id", "intersection_id"), "road"),
    ("signal_group", ("signal_id",), "traffic_signal"),
)
