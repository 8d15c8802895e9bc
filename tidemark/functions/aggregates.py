"""Aggregates as mergeable parts.

Every operation is kept as one or two parts that merge by sum, min, max or "latest":
an average as (sum, count), the latest value as ``struct(tick, value)`` under max.  Parts of
one tick, of one batch or of one block of ticks merge the same way, so each raw row is read
once and everything later works on parts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import Aggregation, QueryConfig

PREFIX = "__p_"


@dataclass(frozen=True)
class Part:
    """One mergeable column: how rows make it within a tick, and how ticks merge."""

    name: str
    operation: str
    field: str

    def of_rows(self) -> Column:
        value = F.lit(1) if self.field == "*" else F.col(self.field)
        if self.operation == "count":
            return F.count(value).alias(self.name)
        if self.operation == "sum":
            return F.sum(value).alias(self.name)
        if self.operation == "min":
            return F.min(value).alias(self.name)
        return F.max(value).alias(self.name)

    @property
    def within(self) -> str:
        """Merge of parts that belong to the same tick."""
        return {"count": "sum", "sum": "sum", "min": "min"}.get(self.operation, "max")

    @property
    def across(self) -> str:
        """Merge of results of different ticks."""
        return "latest" if self.operation == "none" else self.within


def parts_of(config: QueryConfig) -> list[Part]:
    found: dict[str, Part] = {}
    for agg in config.aggregations:
        operations = ("sum", "count") if agg.operation == "avg" else (agg.operation,)
        for operation in operations:
            part = _part(operation, agg.field)
            found[part.name] = part
    return list(found.values())


def _part(operation: str, field: str) -> Part:
    label = "all" if field == "*" else field
    return Part(f"{PREFIX}{operation}_{label}", operation, field)


def merge_column(kind: str, column: str) -> Column:
    """The aggregate that merges a part; "latest" parts are structs led by their tick."""
    if kind == "sum":
        return F.sum(column)
    if kind == "min":
        return F.min(column)
    return F.max(column)


def combine(kind: str, earlier: Column, later: Column) -> Column:
    """Merge two part values, either of which may be null."""
    if kind == "sum":
        return F.coalesce(earlier + later, earlier, later)
    if kind == "min":
        return F.least(earlier, later)
    if kind == "latest":
        return F.coalesce(later, earlier)
    return F.greatest(earlier, later)


def finished(agg: Aggregation, latest_as_struct: bool = True) -> Column:
    """The value a user sees, from the merged parts."""
    if agg.operation == "avg":
        total = F.col(_part("sum", agg.field).name).cast("double")
        count = F.col(_part("count", agg.field).name)
        value = F.coalesce(F.try_divide(total, count), F.lit(0.0))
    else:
        column = F.col(_part(agg.operation, agg.field).name)
        if agg.operation in ("sum", "count"):
            value = F.coalesce(column, F.lit(0))
        elif agg.operation == "none" and latest_as_struct:
            value = column["value"]
        else:
            value = column
    return value.alias(agg.name)


def count_name(agg: Aggregation) -> str:
    """The column that holds an average's row count beside it."""
    return agg.count_field or f"__count_{agg.name}"


def row_count(agg: Aggregation) -> Column:
    """An average's row count, from the merged parts."""
    return F.coalesce(F.col(_part("count", agg.field).name), F.lit(0))


def helper_count(agg: Aggregation) -> Column:
    """The row count that weights an average, one for a latest value, else zero."""
    if agg.operation == "avg":
        return row_count(agg).cast("double")
    return F.lit(1.0 if agg.operation == "none" else 0.0)


def stamp_latest(parts: list[Part], tick: Column) -> dict[str, Column]:
    """Turn "latest" parts of a tick into ``struct(tick, value)`` so that max picks the newest."""
    return {
        p.name: F.struct(tick.alias("tick"), F.col(p.name).alias("value"))
        for p in parts
        if p.across == "latest"
    }
