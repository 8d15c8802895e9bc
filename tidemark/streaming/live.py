"""Queries kept up to date by streaming aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import TICK, ConfigError, QueryConfig, WindowSpec
from tidemark.functions.aggregates import Part, parts_of
from tidemark.functions.values import dimension_key
from tidemark.operators.evaluate import at_one_tick, pinned_rows
from tidemark.operators.landmark import SAME_AS_SOURCE, finish
from tidemark.operators.metrics import DIMENSION, unpivoted, dimensions_of, with_storage_fields
from tidemark.sources.history import write_summary


def _over_all_ticks(part: Part):
    if part.across != "latest":
        return part.of_rows()
    newest = F.struct(F.col(TICK).cast("long").alias("tick"), F.col(part.field).alias("value"))
    return F.max(newest).alias(part.name)


def live_snapshot(rows: DataFrame, config: QueryConfig) -> DataFrame:
    """Each group's cumulative row, for output mode ``complete`` (all groups) or ``update``.

    State is one row per group.  It moves per micro-batch, not per tick; histories come from the
    stored parts instead.
    """
    config.check(rows.schema)
    if not at_one_tick(config):
        raise ConfigError("a query that is not pinned to the current tick reads the stored parts")
    operation = {a.name: a.operation for a in config.aggregations}
    if any((operation[u.source], u.operation) not in SAME_AS_SOURCE for u in config.summary_updates):
        raise ConfigError("a summary update that merges single ticks needs the stored parts")
    merged = pinned_rows(rows, config).groupBy(*config.group_by).agg(
        *(_over_all_ticks(p) for p in parts_of(config))
    )
    return finish(merged, config)


def live_windows(
    rows: DataFrame, config: QueryConfig, window: WindowSpec, lateness: str
) -> DataFrame:
    """Event-time windows (tumbling, or sliding with ``slide``) that close once ``lateness`` has passed.

    Rows that come later than that are dropped by the stream's watermark; its progress counts them.
    """
    if not window.by_time:
        raise ConfigError("event-time windows are measured in seconds")
    step = window.slide or window.size
    # Watermarks begin at the epoch: ticks move behind it by whole steps, which keeps the window starts.
    shift = -(-(1 << 31) // step) * step + step
    span = F.window("__et", f"{window.size} seconds", f"{step} seconds")
    merged = (
        pinned_rows(rows, config)
        .withColumn("__et", F.timestamp_seconds(F.col(TICK).cast("long") + F.lit(shift)))
        .withWatermark("__et", lateness)
        .groupBy(span.alias("__span"), *config.group_by)
        .agg(*(p.of_rows() for p in parts_of(config)))
        .withColumn(TICK, F.unix_timestamp("__span.start") - F.lit(shift))
        .drop("__span")
    )
    return finish(merged, config, latest_as_struct=False).withColumnRenamed(TICK, "window_start")


def live_metrics(rows: DataFrame, config: QueryConfig) -> DataFrame:
    """The summary rows of every dimension value, for output mode ``update`` or ``complete``."""
    config = with_storage_fields(config).check(rows.schema)
    parts = parts_of(config)
    values = [
        F.struct(F.lit(d).alias("field"), F.col(d).cast("string").alias("field_value"))
        for d in dimensions_of(config)
    ]
    merged = (
        pinned_rows(rows, config)
        .withColumn("__dimension", F.explode(F.array(*values)))
        .groupBy(*(F.col(f"__dimension.{c}").alias(c) for c in DIMENSION))
        .agg(*(_over_all_ticks(p) for p in parts), F.max(TICK).cast("int").alias("last_updated_tick"))
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


def start_summary(
    spark: SparkSession, rows: DataFrame, config: QueryConfig, path: str, checkpoint: str
) -> StreamingQuery:
    """Keep the summary table of a stream: every batch writes the rows it changed."""

    def store(changed: DataFrame, batch_id: int) -> None:
        write_summary(changed, path, batch_id)

    return (
        live_metrics(rows, config)
        .writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
