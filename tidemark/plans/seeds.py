"""The built-in queries, by id (fixed values)."""

from __future__ import annotations

from tidemark.config import (
    CURRENT_TICK,
    TICK,
    Aggregation,
    DerivedMetric,
    Filter,
    QueryConfig,
    SummaryUpdate,
    WindowSpec,
)

_NOW = (Filter(TICK, "=", CURRENT_TICK),)
_ROAD = ("road_id", "intersection_id")
_CROSSING = ("intersection_id",)


def _measure(query_id: str, group_by: tuple[str, ...], field: str, short: str, **extra) -> QueryConfig:
    """Sum, max and min of one sensor field, with the packet count."""
    return QueryConfig(
        query_id, "sensor_stream",
        (
            Aggregation(f"s_{short}", "sum", field),
            Aggregation(f"x_{short}", "max", field),
            Aggregation(f"n_{short}", "min", field),
            Aggregation("c_pkt", "count", "*"),
        ),
        group_by, _NOW, **extra,
    )


def _updates(*triples: tuple[str, str, str]) -> tuple[SummaryUpdate, ...]:
    return tuple(SummaryUpdate(*t) for t in triples)


SEEDS: dict[str, QueryConfig] = {
    c.query_id: c
    for c in (
        _measure(
            "RD-SPEED-PKT", _ROAD, "avg_speed", "spd",
            summary_updates=_updates(
                ("pkt_count", "c_pkt", "increment"),
                ("sum_speed", "s_spd", "increment"),
                ("max_speed", "x_spd", "max"),
                ("min_speed", "n_spd", "min"),
            ),
            derived_metrics=(DerivedMetric("avg_speed", "sum_speed / pkt_count"),),
        ),
        _measure(
            "IS-SPEED-PKT", _CROSSING, "avg_speed", "spd",
            derived_metrics=(DerivedMetric("avg_speed", "s_spd / c_pkt"),),
        ),
        _measure(
            "RD-OCC-PKT", _ROAD, "occupancy", "occ",
            summary_updates=_updates(
                ("sum_occupancy", "s_occ", "increment"),
                ("max_occupancy", "x_occ", "max"),
                ("min_occupancy", "n_occ", "min"),
            ),
            derived_metrics=(DerivedMetric("avg_occupancy", "sum_occupancy / pkt_count"),),
        ),
        _measure(
            "IS-OCC-PKT", _CROSSING, "occupancy", "occ",
            derived_metrics=(DerivedMetric("avg_occupancy", "s_occ / c_pkt"),),
        ),
        QueryConfig(
            "RD-VEH-PKT", "sensor_stream", (Aggregation("s_veh", "sum", "vehicle_count"),), _ROAD, _NOW,
            summary_updates=_updates(("total_vehicles", "s_veh", "increment")),
        ),
        QueryConfig(
            "IS-VEH-PKT", "sensor_stream", (Aggregation("s_veh", "sum", "vehicle_count"),), _CROSSING, _NOW,
        ),
        QueryConfig(
            "RD-EVT-PKT", "event_stream", (Aggregation("c_evt", "count", "*"),),
            (*_ROAD, "event_type"), _NOW,
            summary_updates=_updates(("total_count", "c_evt", "increment")),
        ),
        QueryConfig(
            "IS-EVT-PKT", "event_stream", (Aggregation("c_evt", "count", "*"),),
            (*_CROSSING, "event_type"), _NOW,
        ),
    )
}

# RD-OCC-PKT divides by the packet count that RD-SPEED-PKT keeps for the same roads
COMPANIONS = {"RD-OCC-PKT": ("RD-SPEED-PKT",)}

METRICS: dict[str, QueryConfig] = {
    c.query_id: c
    for c in (
        QueryConfig(
            "SENSOR-METRICS", "sensor_stream", (Aggregation("avg_speed_avg", "avg", "avg_speed"),),
            _ROAD, _NOW, dimension_fields=_ROAD,
        ),
        QueryConfig(
            "EVENT-METRICS", "event_stream",
            (
                Aggregation("event_type_count", "count", "event_type"),
                Aggregation("priority_max", "max", "priority"),
            ),
            _ROAD, _NOW, dimension_fields=_ROAD,
        ),
    )
}

# the documented example of a query that names the fields its history keeps
OCCUPANCY_EXAMPLE = {
    "query_id": "IS-OCC-PKT",
    "source": "sensor_stream",
    "filter": {"field": "ts", "operator": "=", "value": CURRENT_TICK},
    "group_by": ["intersection_id"],
    "aggregations": [
        {"name": "s_occ", "operation": "sum", "field": "occupancy"},
        {"name": "x_occ", "operation": "max", "field": "occupancy"},
        {"name": "n_occ", "operation": "min", "field": "occupancy"},
        {"name": "c_pkt", "operation": "count", "field": "*"},
    ],
    "output_buffer": {"store_fields": ["intersection_id", "s_occ", "x_occ", "n_occ", "c_pkt"]},
    "derived_metrics": [{"name": "avg_occ", "formula": "s_occ / c_pkt"}],
}

WINDOWS = {
    "sensor_stream": WindowSpec("Sliding", 5, "seconds", slide=10),
    "event_stream": WindowSpec("Tumbling", 10, "events"),
    "command_stream": WindowSpec("Landmark"),
}
