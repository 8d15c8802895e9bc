"""Run a query config over a stream: one call, DataFrame in, DataFrame out."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.config import CURRENT_TICK, TICK, ConfigError, QueryConfig, WindowSpec
from tidemark.functions.aggregates import merge_column, parts_of
from tidemark.operators import landmark
from tidemark.operators.clock import due_ticks, numbered, ticks_of
from tidemark.operators.evaluate import (
    at_one_tick,
    moves_with_tick,
    over_retained,
    parts_by_own_tick,
    per_tick,
    pinned_rows,
    selected,
)
from tidemark.operators.metrics import (
    history_of_parts,
    merged_metric_parts,
    metric_history,
    metric_parts,
    metric_summary,
    with_storage_fields,
)
from tidemark.operators.retention import retained
from tidemark.session import settled

MODES = ("snapshot", "changed", "history")


def run_query(
    df: DataFrame,
    config: QueryConfig,
    mode: str = "snapshot",
    *,
    window: WindowSpec | None = None,
    merge: bool = True,
    frequency: int = 1,
    clock: DataFrame | None = None,
    skip_tick_zero: bool = False,
    key: str | None = None,
    companions: Sequence[QueryConfig] = (),
) -> DataFrame:
    """Evaluate ``config`` at every due tick of ``df``.

    ``mode``: ``snapshot`` gives each group's newest cumulative row, ``changed`` a row per tick
    and group that had rows, ``history`` every group seen so far at every due tick.
    ``merge=False`` returns the results of single ticks without merging them.  ``clock`` lists
    the ticks when other streams also drive the clock.  ``window`` and ``key`` (the stream's
    primary key) matter when no filter pins the current tick.  ``companions`` are queries over
    the same groups whose summary targets the derived metrics may use.  In the result ``ts`` is
    the tick; a query grouped by ``ts`` itself finds that key as ``ts_key``.
    """
    if mode not in MODES:
        raise ConfigError(f"mode must be one of {MODES}")
    config.check(df.schema)
    if TICK in config.group_by:
        df = df.withColumn(f"{TICK}_key", F.col(TICK))
        config = replace(config, group_by=tuple(f"{TICK}_key" if k == TICK else k for k in config.group_by))
    wide = with_companions(config, companions, df.schema)
    pinned = at_one_tick(wide)
    window = window or WindowSpec()
    trimmed_tick = pinned and window.by_rows
    every_tick = frequency <= 1 and clock is None and not skip_tick_zero
    ticks = None

    if pinned and not trimmed_tick:
        if mode == "snapshot" and merge and every_tick and not landmark.needs_ticks(wide):
            return _shaped(_one_pass(df, wide), wide, config)
        parts = per_tick(df, wide)
        if not every_tick:
            due = _due(df, clock, frequency, skip_tick_zero)
            if mode == "history" and merge:
                ticks = numbered(due)
                due = ticks.select(TICK)
            parts = parts.join(due, TICK, "left_semi")
    else:
        if window.by_rows and key is None:
            raise ConfigError("a row-count window needs the stream's key")
        rows, clocked = df, df
        if not window.by_rows and moves_with_tick(wide):
            rows = settled(parts_by_own_tick(df, wide), "parts")
            # without filters every tick of the stream has parts, so the stream is scanned once
            clocked = df if wide.has_row_filters else rows
        ticks = numbered(_due(clocked, clock, frequency, skip_tick_zero))
        parts = over_retained(rows, wide, window, ticks, key)

    if ticks is None and merge and mode == "history":
        parts = settled(parts, "parts")
        ticks = numbered(ticks_of(df if wide.has_row_filters else parts))
        return _shaped(landmark.dense_history(parts, wide, ticks), wide, config)
    return _result(parts, wide, config, mode, merge, ticks)


def _result(
    parts: DataFrame, wide: QueryConfig, config: QueryConfig, mode: str, merge: bool, ticks: DataFrame | None
) -> DataFrame:
    """The results of single ticks, as they are or merged as ``mode`` says."""
    if not merge:
        return _shaped(parts, wide, config, latest_as_struct=False)
    if mode == "snapshot":
        return _shaped(landmark.snapshot(parts, wide), wide, config)
    if mode == "changed":
        return _shaped(landmark.sparse_history(parts, wide), wide, config)
    return _shaped(landmark.dense_history(settled(parts, "parts"), wide, ticks), wide, config)


def run_tick(
    df: DataFrame,
    config: QueryConfig,
    tick: int,
    *,
    window: WindowSpec | None = None,
    key: str | None = None,
) -> DataFrame:
    """What the query returns at one tick, from the rows the stream then holds.

    Averages come with their row counts, so that ``merge_snapshots`` can fold the result into an
    earlier one.
    """
    config.check(df.schema)
    bound = replace(
        config, filters=tuple(replace(f, value=tick) if f.on_tick else f for f in config.filters)
    )
    rows = df.where(F.col(TICK) <= tick)
    if window is not None and (window.by_rows or not at_one_tick(config)):
        rows = retained(rows, window, key)
    parts = selected(rows, bound).groupBy(*config.group_by).agg(*(p.of_rows() for p in parts_of(config)))
    plain = replace(config, summary_updates=(), derived_metrics=())
    return landmark.finish(parts, plain, latest_as_struct=False, helpers=True)


def parts_to_store(df: DataFrame, config: QueryConfig, companions: Sequence[QueryConfig] = ()) -> DataFrame:
    """The parts per tick and group from which :func:`history_from_parts` reads every result."""
    config = with_companions(config, companions, df.schema)
    if at_one_tick(config):
        return per_tick(df, config)
    if not moves_with_tick(config):
        raise ConfigError("a comparison of the current tick with another field needs the rows themselves")
    return parts_by_own_tick(df, config)


def history_from_parts(
    parts: DataFrame,
    config: QueryConfig,
    mode: str = "history",
    *,
    window: WindowSpec | None = None,
    merge: bool = True,
    frequency: int = 1,
    clock: DataFrame | None = None,
    skip_tick_zero: bool = False,
    companions: Sequence[QueryConfig] = (),
) -> DataFrame:
    """The same results from stored per-tick parts, of which several may share a tick and group.

    ``clock`` lists all ticks of the stream, and of others that drive the clock; without it the clock
    is the ticks that have parts.  ``companions`` must be those the parts were stored with.
    """
    if mode not in MODES:
        raise ConfigError(f"mode must be one of {MODES}")
    wide = with_companions(config, companions)
    window = window or WindowSpec()
    merged = parts.groupBy(*wide.group_by, TICK).agg(
        *(merge_column(p.within, p.name).alias(p.name) for p in parts_of(wide))
    )
    if window.by_rows:
        raise ConfigError("a row-count window is read from its newest rows: history_from_newest")
    merged = settled(merged, "parts")
    ticks = numbered(_due(merged, clock, frequency, skip_tick_zero))
    if at_one_tick(wide):
        merged = merged.join(ticks.select(TICK), TICK, "left_semi")
    else:
        merged = over_retained(merged, wide, window, ticks, None)
    return _result(merged, wide, config, mode, merge, ticks)


def history_from_newest(
    rows: DataFrame,
    counts: DataFrame,
    config: QueryConfig,
    mode: str = "history",
    *,
    window: WindowSpec,
    key: str,
    merge: bool = True,
    frequency: int = 1,
    clock: DataFrame | None = None,
    skip_tick_zero: bool = False,
    companions: Sequence[QueryConfig] = (),
) -> DataFrame:
    """The results over a row-count window from the stored newest rows of every tick and the rows per tick.

    ``rows`` and ``counts`` are :func:`newest_of_ticks` and :func:`rows_per_tick` of the batches so far.
    """
    if mode not in MODES:
        raise ConfigError(f"mode must be one of {MODES}")
    if not window.by_rows:
        raise ConfigError("only a row-count window is read from the newest rows")
    wide = with_companions(config, companions)
    counts = settled(counts.groupBy(TICK).agg(F.sum("n").alias("n")), "counts")
    ticks = numbered(_due(counts, clock, frequency, skip_tick_zero))
    parts = over_retained(rows, wide, window, ticks, key, counts)
    return _result(parts, wide, config, mode, merge, ticks)


def run_metrics(
    df: DataFrame,
    config: QueryConfig,
    mode: str = "changed",
    *,
    frequency: int = 1,
    clock: DataFrame | None = None,
    skip_tick_zero: bool = False,
) -> DataFrame:
    """Long-format metrics: ``changed`` gives the history per tick, ``summary`` the summary table."""
    config = with_storage_fields(config).check(df.schema)
    if mode not in ("changed", "summary"):
        raise ConfigError("mode must be 'changed' or 'summary'")
    every_tick = frequency <= 1 and clock is None and not skip_tick_zero
    due = None if every_tick else _due(df, clock, frequency, skip_tick_zero)
    if mode == "summary":
        if due is not None:
            df = df.join(due, TICK, "left_semi")
        return metric_summary(df, config)
    return metric_history(df, config, due, all_due=every_tick)


def metrics_to_store(df: DataFrame, config: QueryConfig) -> DataFrame:
    """The parts from which :func:`metrics_from_parts` reads the long metrics."""
    return metric_parts(df, with_storage_fields(config).check(df.schema))


def metrics_from_parts(
    parts: DataFrame,
    config: QueryConfig,
    clock: DataFrame,
    *,
    frequency: int = 1,
    skip_tick_zero: bool = False,
) -> DataFrame:
    """The history of the long metrics from stored parts; ``clock`` lists all ticks of the stream or streams."""
    config = with_storage_fields(config)
    merged = settled(merged_metric_parts(parts, config), "parts")
    return history_of_parts(merged, config, due_ticks(ticks_of(clock), frequency, skip_tick_zero))


def run_sql(spark: SparkSession, text: str, tick: int, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run a query given as SQL text over the streams, with the current tick bound as a value.

    Inside quotes the marker becomes the tick's digits.  ``views`` hide the session's own views of
    the same names only while the text is read.
    """
    quoted = r"""('(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.)*"|`[^`]*`)"""
    pieces = re.split(quoted, text)
    bound = [p.replace(CURRENT_TICK, str(tick) if i % 2 else ":current_tick") for i, p in enumerate(pieces)]
    own = {v.name: spark.table(v.name) for v in spark.catalog.listTables() if v.isTemporary and v.name in (views or {})}
    try:
        for name, df in (views or {}).items():
            df.createOrReplaceTempView(name)
        return spark.sql("".join(bound), args={"current_tick": tick})
    finally:
        for name in views or {}:
            if name in own:
                own[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def _due(df: DataFrame, clock: DataFrame | None, frequency: int, skip_tick_zero: bool) -> DataFrame:
    return due_ticks(ticks_of(df if clock is None else clock), frequency, skip_tick_zero)


def _one_pass(df: DataFrame, config: QueryConfig) -> DataFrame:
    """Cumulative values that need no single ticks: one aggregation over the rows."""
    return pinned_rows(df, config).groupBy(*config.group_by).agg(*(p.of_rows() for p in parts_of(config)))


def with_companions(
    config: QueryConfig, companions: Sequence[QueryConfig], schema: StructType | None = None
) -> QueryConfig:
    """The config with the aggregates and summary targets of queries over the same groups."""
    aggregations, updates = list(config.aggregations), list(config.summary_updates)
    for other in companions:
        if schema is not None:
            other.check(schema)
        if (other.source, other.group_by, other.filters) != (config.source, config.group_by, config.filters):
            raise ConfigError(f"{other.query_id} does not share the groups of {config.query_id}")
        have = {a.name for a in aggregations}
        aggregations += [a for a in other.aggregations if a.name not in have]
        targets = {u.target for u in updates}
        updates += [u for u in other.summary_updates if u.target not in targets]
    return replace(config, aggregations=tuple(aggregations), summary_updates=tuple(updates))


def _shaped(
    parts: DataFrame, wide: QueryConfig, config: QueryConfig, latest_as_struct: bool = True
) -> DataFrame:
    rows = landmark.finish(parts, wide, latest_as_struct)
    if wide.aggregations == config.aggregations and wide.summary_updates == config.summary_updates:
        return rows
    own = [TICK] if TICK in rows.columns else []
    own += [*config.group_by, *(a.name for a in config.aggregations)]
    own += [u.target for u in config.summary_updates] + [m.name for m in config.derived_metrics]
    return rows.select(*own)
