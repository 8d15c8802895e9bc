"""Query and window settings as plain values, with the argument checks.

A query reads one stream, keeps the rows that pass every filter, groups them and
aggregates them once per tick.  ``CURRENT_TICK`` inside a filter stands for the
tick being evaluated.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql.types import NumericType, StructType

# The words a configuration may use.
CURRENT_TICK = "{CURRENT_TICK}"
OPERATIONS = ("sum", "count", "avg", "min", "max", "none")
COMPARISONS = ("=", "!=", "<>", ">", ">=", "<", "<=")
UPDATE_OPERATIONS = ("increment", "max", "min", "replace")
WINDOW_KINDS = ("Sliding", "Tumbling", "Landmark")
WINDOW_UNITS = ("seconds", "packets", "events", "")
NAME_PATTERN = r"^[A-Za-z_][A-Za-z0-9_]*$"

TICK = "ts"


class ConfigError(ValueError):
    """A query or window setting that cannot be run."""


@dataclass(frozen=True)
class Filter:
    field: str
    operator: str = "="
    value: Any = None

    @property
    def on_tick(self) -> bool:
        return self.value == CURRENT_TICK


@dataclass(frozen=True)
class Aggregation:
    name: str
    operation: str
    field: str = "*"
    count_field: str | None = None


@dataclass(frozen=True)
class SummaryUpdate:
    target: str
    source: str
    operation: str


@dataclass(frozen=True)
class DerivedMetric:
    name: str
    formula: str


@dataclass(frozen=True)
class WindowSpec:
    """How much of a stream is kept: the last ``size`` ticks or rows, or everything."""

    kind: str = "Landmark"
    size: int = 0
    unit: str = ""
    slide: int | None = None

    @classmethod
    def checked(cls, kind: str, size: int = 0, unit: str = "", slide: int | None = None) -> WindowSpec:
        if kind not in WINDOW_KINDS:
            raise ConfigError(f"window kind must be one of {WINDOW_KINDS}, not {kind!r}")
        if unit not in WINDOW_UNITS:
            raise ConfigError(f"window unit must be one of {WINDOW_UNITS}, not {unit!r}")
        if kind != "Landmark" and size <= 0:
            raise ConfigError("window size must be positive")
        if slide is not None and slide <= 0:
            raise ConfigError("slide must be positive")
        return cls(kind, size, unit, slide)

    @property
    def by_time(self) -> bool:
        return self.kind in ("Sliding", "Tumbling") and self.unit == "seconds"

    @property
    def by_rows(self) -> bool:
        return self.kind in ("Sliding", "Tumbling") and self.unit in ("packets", "events")


@dataclass(frozen=True)
class QueryConfig:
    query_id: str
    source: str
    aggregations: tuple[Aggregation, ...]
    group_by: tuple[str, ...] = ()
    filters: tuple[Filter, ...] = ()
    dimension_fields: tuple[str, ...] | None = None
    summary_updates: tuple[SummaryUpdate, ...] = ()
    derived_metrics: tuple[DerivedMetric, ...] = ()
    store_fields: tuple[str, ...] = ()

    @property
    def has_row_filters(self) -> bool:
        """Whether any filter can drop rows at their own tick."""
        return any(not f.on_tick or f.field != TICK for f in self.filters)

    @classmethod
    def from_dict(cls, raw: dict | str, query_id: str | None = None) -> QueryConfig:
        """A config from its JSON form; all faults of that form are reported together."""
        faults: list[str] = []
        values = _read(json.loads(raw) if isinstance(raw, str) else raw, _CONFIG, "query config", faults)
        stored = _read(values.pop("output_buffer", {}), _BUFFER, "output_buffer", faults)
        items = {
            name: tuple(kind(**_read(item, _ITEMS[kind], name, faults)) for item in values.pop(key, []))
            for key, (name, kind) in _LISTS.items()
        }
        if not items["aggregations"]:
            faults.append("aggregations must be a list with at least one item")
        if faults:
            raise ConfigError("; ".join(faults))
        names = {k: tuple(values[k]) for k in ("group_by", "dimension_fields")}
        return cls(
            query_id=query_id or values["query_id"],
            source=values["source"],
            **items,
            group_by=names["group_by"],
            dimension_fields=names["dimension_fields"] or None,
            store_fields=tuple(stored.get("store_fields", ())),
        )

    def check(self, schema: StructType, source: str | None = None) -> QueryConfig:
        """Raise ConfigError unless every name and operation fits the stream's schema."""
        if source is not None and self.source != source:
            raise ConfigError(f"{self.query_id} reads {self.source!r}, not {source!r}")
        for key in self.group_by:
            _known(key, schema, "group key")
        if not self.aggregations:
            raise ConfigError("aggregations must be a list with at least one item")
        names = [a.name for a in self.aggregations]
        for agg in self.aggregations:
            _name(agg.name, "aggregation name")
            if agg.operation not in OPERATIONS:
                raise ConfigError(f"unknown operation {agg.operation!r}")
            if agg.field == "*":
                if agg.operation != "count":
                    raise ConfigError(f"{agg.operation} needs a field, not '*'")
            else:
                _known(agg.field, schema, "aggregation field")
                numeric = isinstance(schema[agg.field].dataType, NumericType)
                if agg.operation in ("sum", "avg") and not numeric:
                    raise ConfigError(f"{agg.operation}({agg.field}) needs a number column")
            if agg.count_field and agg.count_field not in names:
                raise ConfigError(f"count_field {agg.count_field!r} names no aggregation")
        for item in self.filters:
            _known(item.field, schema, "filter field")
            if item.operator not in COMPARISONS:
                raise ConfigError(f"unknown filter operator {item.operator!r}")
        for field in self.dimension_fields or ():
            _known(field, schema, "dimension field")
        for update in self.summary_updates:
            _name(update.target, "summary target")
            if update.operation not in UPDATE_OPERATIONS:
                raise ConfigError(f"unknown summary operation {update.operation!r}")
            if update.source not in names:
                raise ConfigError(f"summary source {update.source!r} names no aggregation")
        for metric in self.derived_metrics:
            _name(metric.name, "derived metric")
        return self

    def with_standard_names(self) -> QueryConfig:
        """Aggregations called after what they compute; ``speed`` of the sensor stream is ``avg_speed``."""
        alias = {"speed": "avg_speed"} if self.source == "sensor_stream" else {}
        fields = [alias.get(a.field, a.field) for a in self.aggregations]
        return replace(self, aggregations=tuple(
            replace(a, field=f, name="_".join([f.replace("*", "all"), a.operation]))
            for a, f in zip(self.aggregations, fields, strict=True)
        ))


# The fields of the JSON form, their types and defaults.
_CONFIG = {
    "query_id": (str, ""), "source": (str, ""), "group_by": (list, []), "filter": (list, []),
    "aggregations": (list, []), "dimension_fields": (list, []), "summary_updates": (list, []),
    "derived_metrics": (list, []), "output_buffer": (dict, {}),
}
_BUFFER = {"store_fields": (list, [])}
_ITEMS = {
    Filter: {"field": (str, None), "operator": (str, "="), "value": (object, None)},
    Aggregation: {"name": (str, None), "operation": (str, ""), "field": (str, "*"), "count_field": (str, None)},
    SummaryUpdate: {"target": (str, None), "source": (str, None), "operation": (str, None)},
    DerivedMetric: {"name": (str, None), "formula": (str, None)},
}
# The lists of items, under their JSON names and as config fields.
_LISTS = {
    "filter": ("filters", Filter), "aggregations": ("aggregations", Aggregation),
    "summary_updates": ("summary_updates", SummaryUpdate), "derived_metrics": ("derived_metrics", DerivedMetric),
}
# How a value is cleaned after reading.
_CLEANED = {"operator": str.strip, "operation": str.lower}


def _read(raw: Any, fields: dict[str, tuple[type, Any]], label: str, faults: list[str]) -> dict[str, Any]:
    """The known fields of a JSON object by their table; what is missing, null or empty has its default.

    A lone filter object is a list of one.  Faults are added to ``faults``.
    """
    given = raw if isinstance(raw, dict) else {}
    if given is not raw:
        faults.append(f"{label}: an object must stand here, not {raw!r}")
    values = {}
    for name, (kind, default) in fields.items():
        value = given.get(name)
        if kind is not object and value in (None, "", [], {}):
            value = default
        if name == "filter" and isinstance(value, dict):
            value = [value]
        if not isinstance(value, kind) and value is not default:
            faults.append(f"{label}: {name} must be a {kind.__name__}, not {value!r}")
            value = default
        clean = _CLEANED.get(name)
        values[name] = clean(value) if clean and value is not None else value
    return values


def _name(value: Any, label: str) -> None:
    if not isinstance(value, str) or not re.match(NAME_PATTERN, value):
        raise ConfigError(f"{label} {value!r} is not a plain name")


def _known(field: Any, schema: StructType, label: str) -> None:
    _name(field, label)
    if field not in schema.fieldNames():
        raise ConfigError(f"{label} {field!r} is not a column of the stream")
