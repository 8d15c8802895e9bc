"""Long-format metrics: one row per dimension value, field and aggregate."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import TICK, QueryConfig
from tidemark.functions.aggregates import finished, helper_count, merge_column, parts_of, stamp_latest
from tidemark.functions.values import dimension_key, display_name, number_or, storage_field
from tidemark.operators.clock import last_ordinal, numbered, with_ordinal
from tidemark.operators.evaluate import pinned_rows
from tidemark.operators.intervals import repeat_over
from tidemark.operators.scan import running
from tidemark.session import settled

DIMENSION = ["field", "field_value"]


def dimensions_of(config: QueryConfig) -> tuple[str, ...]:
    """The config's dimensions; road and intersection for the two streams that have them."""
    if config.dimension_fields:
        return config.dimension_fields
    return ("road_id", "intersection_id") if config.source in ("sensor_stream", "event_stream") else ()


def with_storage_fields(config: QueryConfig) -> QueryConfig:
    return replace(
        config,
        aggregations=tuple(
            replace(a, field=storage_field(config.source, a.field)) for a in config.aggregations
        ),
    )


def metric_parts(df: DataFrame, config: QueryConfig) -> DataFrame:
    """Parts per tick and dimension value: all dimensions and aggregates in one pass."""
    parts = parts_of(config)
    rows = pinned_rows(df, config)
    values = [
        F.struct(F.lit(d).alias("field"), F.col(d).cast("string").alias("field_value"))
        for d in dimensions_of(config)
    ]
    if not values:
        rows = rows.where(F.lit(False))
        values = [F.struct(F.lit("").alias("field"), F.lit("").alias("field_value"))]
    wanted = sorted({p.field for p in parts if p.field != "*"} - {TICK})
    per_tick = (
        rows.select(
            F.explode(F.array(*values)).alias("__dimension"),
            F.col(TICK).cast("long").alias(TICK),
            *wanted,
        )
        .select("__dimension.*", TICK, *wanted)
        .groupBy(*DIMENSION, TICK)
        .agg(*(p.of_rows() for p in parts))
    )
    numbers = {p.name: F.col(p.name).try_cast("double") for p in parts if p.operation in ("min", "max", "none")}
    return per_tick.withColumns(numbers) if numbers else per_tick


def _running(
    df: DataFrame,
    config: QueryConfig,
    position: str,
    next_position: str | None = None,
) -> DataFrame:
    parts = parts_of(config)
    stamped = stamp_latest(parts, F.col(TICK))
    rows = df.withColumns(stamped) if stamped else df
    merges = {p.name: p.across for p in parts}
    return running(rows, DIMENSION, position, merges, next_position)


def unpivoted(rows: DataFrame, config: QueryConfig) -> DataFrame:
    """One row per aggregate from rows that hold the merged parts of all of them."""
    items = [
        F.struct(
            F.lit(display_name(config.source, "*" if a.field == "*" else a.field)).alias("metric"),
            F.lit(a.operation).alias("aggregate"),
            number_or(finished(a)).alias("value"),
            helper_count(a).alias("helper_count"),
        )
        for a in config.aggregations
    ]
    kept = [c for c in rows.columns if not c.startswith("__p_")]
    return rows.select(*kept, F.explode(F.array(*items)).alias("__item")).select(*kept, "__item.*")


def metric_history(
    df: DataFrame, config: QueryConfig, due: DataFrame, all_due: bool = False
) -> DataFrame:
    """At each due tick the dimension values present in it; at one without rows, all so far.

    ``all_due`` says that every tick of ``df`` is in ``due`` and no other is.
    """
    return history_of_parts(metric_parts(df, config), config, due, all_due)


def merged_metric_parts(parts: DataFrame, config: QueryConfig) -> DataFrame:
    """Stored :func:`metric_parts` of several batches as one row per tick and dimension value."""
    return parts.groupBy(*DIMENSION, TICK).agg(
        *(merge_column(p.within, p.name).alias(p.name) for p in parts_of(config))
    )


def history_of_parts(
    parts: DataFrame, config: QueryConfig, due: DataFrame, all_due: bool = False
) -> DataFrame:
    """:func:`metric_history` from parts with a row per tick and dimension value."""
    if all_due:
        return unpivoted(_running(parts, config, TICK), config).drop("helper_count")
    ticks = numbered(due)
    at_due = settled(with_ordinal(parts, ticks), "parts")
    active = at_due.select(TICK).distinct()
    empty = numbered(ticks.select(TICK).join(active, TICK, "left_anti"))
    changed = _running(at_due, config, "ord", "__next").drop("ord")
    present = changed.drop("__next")
    n_empty = last_ordinal(empty)
    if n_empty == 0:
        return unpivoted(present, config).drop("helper_count")

    # a row stands for its key at the empty ticks up to the key's next change
    marks = active.select(TICK, F.lit(None).cast("long").alias("n")).unionByName(
        empty.select(TICK, F.col("ord").alias("n"))
    )
    passed = running(marks, [], TICK, {"n": "max"}).join(ticks, TICK)
    passed = settled(passed.select(TICK, "ord", F.coalesce("n", F.lit(0)).alias("n")), "passed")
    nexts = passed.select(F.col("ord").alias("__next"), F.col("n").alias("__stop"))
    ranged = (
        changed.join(passed.select(TICK, F.col("n").alias("__before")), TICK)
        .join(nexts, "__next", "left")
        .withColumns(
            {"__first": F.col("__before") + 1, "__stop": F.coalesce("__stop", F.lit(n_empty).cast("long"))}
        )
        .drop("__before", "__next")
    )
    dumped = repeat_over(ranged, "__first", "__stop", empty)
    return unpivoted(present.unionByName(dumped), config).drop("helper_count")


def metric_summary(df: DataFrame, config: QueryConfig) -> DataFrame:
    """The summary table: the newest value and helper count per stream, metric, aggregate, dimension."""
    parts = parts_of(config)
    per_tick = metric_parts(df, config)
    stamped = stamp_latest(parts, F.col(TICK))
    rows = per_tick.withColumns(stamped) if stamped else per_tick
    merged = rows.groupBy(*DIMENSION).agg(
        *(merge_column(p.across, p.name).alias(p.name) for p in parts),
        F.max(TICK).cast("int").alias("last_updated_tick"),
    )
    return unpivoted(merged, config).select(
        F.lit(config.source).alias("stream_name"),
        F.col("metric").alias("metric_field"),
        F.col("aggregate").alias("aggregate_name"),
        dimension_key(F.col("field"), F.col("field_value")).alias("dimensions"),
        "value",
        "helper_count",
        "last_updated_tick",
    )
