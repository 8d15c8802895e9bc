"""Filters of a query as Column conditions."""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType, StructType

from tidemark.config import Filter

# outside the 32-bit range of ticks, on either side
BEYOND = 1 << 40

_COMPARE = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<>": lambda a, b: a != b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}


def comparison(field: Column, operator: str, value: Any, dtype: DataType) -> Column:
    """``field operator value``; null on either side, or a literal of the wrong kind, never matches."""
    literal = F.lit(value)
    if isinstance(value, bool):
        literal = F.lit(int(value))
    if isinstance(dtype, StringType):
        if isinstance(value, (bool, int, float)):
            field = field.try_cast("double")
    elif isinstance(dtype, NumericType):
        if isinstance(value, str):
            literal = literal.try_cast("double")
    else:
        literal = literal.try_cast(dtype)
    return _COMPARE[operator](field, literal)


def row_condition(filters: tuple[Filter, ...], schema: StructType) -> Column | None:
    """All filters against constants, joined by AND; None when there is none."""
    conditions = [
        comparison(F.col(f.field), f.operator, f.value, schema[f.field].dataType)
        for f in filters
        if not f.on_tick
    ]
    return reduce(and_, conditions) if conditions else None


def validity(filters: tuple[Filter, ...], first: Column, last: Column) -> Column:
    """The tick ranges in which a row passes its comparisons with the current tick.

    ``field <= {CURRENT_TICK}`` holds from the tick ``field`` on, ``field >= {CURRENT_TICK}``
    up to it, and so on, so each comparison only narrows ``[first, last]``; ``!=`` splits it.
    Returns an array of ``struct(lo, hi)``; empty ranges are left to the caller to drop.
    """
    ranges = [(first, last)]
    for f in filters:
        if not f.on_tick:
            continue
        value = number(F.col(f.field))
        low, high = F.floor(value), F.ceil(value)
        narrowed = []
        for lo, hi in ranges:
            if f.operator == "=":
                narrowed.append((_later(lo, high), _earlier(hi, low)))
            elif f.operator == "<":
                narrowed.append((_later(lo, low + 1), hi))
            elif f.operator == "<=":
                narrowed.append((_later(lo, high), hi))
            elif f.operator == ">":
                narrowed.append((lo, _earlier(hi, high - 1)))
            elif f.operator == ">=":
                narrowed.append((lo, _earlier(hi, low)))
            else:
                narrowed.append((lo, _earlier(hi, high - 1)))
                narrowed.append((_later(lo, low + 1), hi))
        ranges = narrowed
    return F.array(*(F.struct(lo.cast("long").alias("lo"), hi.cast("long").alias("hi")) for lo, hi in ranges))


def number(field: Column) -> Column:
    """A field to compare with ticks: no number is null, and values beyond all ticks are cut to just beyond them."""
    value = field.try_cast("double")
    inside = F.greatest(F.least(value, F.lit(float(BEYOND))), F.lit(float(-BEYOND)))
    return F.when(~F.isnan(value), inside)


def _later(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def _earlier(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))
