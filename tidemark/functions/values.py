"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_or(value: Column, default: float = 0.0) -> Column:
    """The value as a double, or the default when it is null or not a number."""
    return F.coalesce(value.try_cast("double"), F.lit(float(default)))


def whole_number_text(value: Column) -> Column:
    """A double as JSON text: whole numbers without a fraction."""
    whole = (value == F.floor(value)) & (F.abs(value) < F.lit(9.0e15))
    return F.when(whole, value.cast("long").cast("string")).otherwise(value.cast("string"))


def object_list(result: Column) -> Column:
    """A JSON result as an array of string maps.

    A lone object counts as a list of one; bad JSON and non-object elements give nothing.
    """
    elements = F.from_json(result, "array<string>")
    parsed = F.transform(elements, lambda item: F.from_json(item, "map<string,string>"))
    listed = F.filter(parsed, lambda item: item.isNotNull() & (F.size(item) > 0))
    lone = F.from_json(result, "map<string,string>")
    is_list = F.ltrim(result).startswith("[")
    empty = F.array().cast("array<map<string,string>>")
    return (
        F.when(is_list, F.coalesce(listed, empty))
        .when(lone.isNotNull(), F.array(lone))
        .otherwise(empty)
    )


def dimension_key(field: Column, field_value: Column) -> Column:
    """Compact JSON text that names one dimension value."""
    return F.to_json(
        F.struct(field.alias("field"), field_value.alias("field_value")),
        {"ignoreNullFields": "false"},
    )


def display_name(source: str, field: str) -> str:
    return "speed" if source == "sensor_stream" and field == "avg_speed" else field


def storage_field(source: str, metric: str) -> str:
    return "avg_speed" if source == "sensor_stream" and metric == "speed" else metric
