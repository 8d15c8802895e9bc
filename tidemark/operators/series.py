"""Series read back from result histories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import TICK
from tidemark.functions.values import object_list
from tidemark.operators.retention import newest_ticks

# dimensions an old-shape result row may be keyed by, in order of preference
OLD_DIMENSIONS = ("road_id", "intersection_id", "event_type")
POINT = ["ts", "value", "field", "field_value", "metric", "aggregate"]


def exploded(history: DataFrame) -> DataFrame:
    """One row per result object: ``id``, ``query_id``, ``ts`` and the object as a string map."""
    return history.select("id", "query_id", TICK, F.explode(object_list(F.col("result"))).alias("item"))


def wide_series(
    history: DataFrame,
    query_id: str,
    y_field: str,
    filter_field: str = "",
    filter_value: str = "",
    window: int = 60,
) -> DataFrame:
    """Points ``(ts, value)`` of one field of a query's results over its last ``window`` ticks.

    Result objects without a number in that field give no point; true and false are no numbers.
    """
    recent = newest_ticks(
        history.where(F.col("query_id") == query_id), window if window > 0 else 60, floor_at_zero=True
    )
    items = exploded(recent)
    if filter_field:
        text = F.coalesce(F.col("item")[filter_field], F.lit(""))
        items = items.where(text == filter_value)
    return items.select("id", TICK, F.col("item")[y_field].try_cast("double").alias("value")).where(
        F.col("value").isNotNull()
    )


def wide_points(
    results: DataFrame, y_field: str, filter_field: str = "", filter_value: str = "", window: int = 60
) -> DataFrame:
    """:func:`wide_series` from typed results: one scan of the wanted columns, no JSON."""
    recent = newest_ticks(results, window if window > 0 else 60, floor_at_zero=True)
    if filter_field:
        recent = recent.where(F.coalesce(F.col(filter_field).cast("string"), F.lit("")) == filter_value)
    value = F.col(y_field).try_cast("double")
    return recent.select(F.col(TICK).cast("long").alias(TICK), value.alias("value")).where(F.col("value").isNotNull())


def field_names(history: DataFrame, query_id: str) -> DataFrame:
    """The field names seen in a query's results."""
    return (
        exploded(history.where(F.col("query_id") == query_id))
        .select(F.explode(F.map_keys("item")).alias("field"))
        .distinct()
    )


def last_tick(history: DataFrame) -> DataFrame:
    """The newest tick of every query's history."""
    return history.groupBy("query_id").agg(F.max(TICK).alias("last_ts"))


def latest_result(history: DataFrame) -> DataFrame:
    """The last stored result of every query."""
    newest = last_tick(history).withColumnRenamed("last_ts", TICK)
    return history.join(newest, ["query_id", TICK], "left_semi")


def long_rows(history: DataFrame) -> DataFrame:
    """Long-format metric rows from JSON results, including rows of the old shape."""
    item = F.col("item")
    old_field = F.coalesce(
        *(F.when(F.map_contains_key(item, d), F.lit(d)) for d in OLD_DIMENSIONS)
    )
    metric = F.coalesce(item["metric"], item["metric_field"])
    field = F.coalesce(item["field"], old_field)
    rows = exploded(history).select(
        "id",
        "query_id",
        TICK,
        field.alias("field"),
        F.when(item["field"].isNotNull(), item["field_value"])
        .otherwise(F.try_element_at(item, old_field))
        .alias("field_value"),
        F.when(metric == "avg_speed", "speed").otherwise(metric).alias("metric"),
        item["aggregate"].alias("aggregate"),
        item["value"].try_cast("double").alias("value"),
    )
    return rows


def long_series(
    rows: DataFrame,
    field: str,
    metric: str,
    aggregate: str,
    field_value: str = "",
    window: int = 60,
) -> DataFrame:
    """Distinct points of one metric over the last ``window`` ticks that have a point."""
    name = "speed" if metric == "avg_speed" else metric
    chosen = rows.where(
        (F.col("field") == field) & (F.col("metric") == name) & (F.col("aggregate") == aggregate)
    ).where(F.col("value").isNotNull())
    if field_value:
        chosen = chosen.where(F.trim("field_value") == field_value)
    return newest_ticks(chosen.select(*POINT).dropDuplicates(POINT), window).select(TICK, "value")


def available(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """The distinct (field, field_value, metric, aggregate) combinations seen."""
    seen = (
        rows.where(
            F.col("field").isNotNull() & F.col("metric").isNotNull() & F.col("aggregate").isNotNull()
        )
        .select("field", "field_value", "metric", "aggregate")
        .distinct()
    )
    if limit is None:
        return seen
    return seen.orderBy("field", "field_value", "metric", "aggregate").limit(limit)
