"""Beginning-to-now results: per-tick results merged into running values per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import TICK, QueryConfig, SummaryUpdate
from tidemark.functions.aggregates import (
    count_name,
    finished,
    merge_column,
    parts_of,
    row_count,
    stamp_latest,
)
from tidemark.functions.formulas import formula_column
from tidemark.operators.clock import last_ordinal, with_ordinal
from tidemark.operators.intervals import repeat_over
from tidemark.operators.scan import running

# How a summary update merges tick after tick.
UPDATE_MERGES = {"increment": "sum", "max": "max", "min": "min", "replace": "latest"}
# updates that equal the cumulative value of their source aggregate
SAME_AS_SOURCE = {
    ("sum", "increment"), ("count", "increment"), ("max", "max"), ("min", "min"), ("none", "replace"),
}


def _own_updates(config: QueryConfig) -> list[SummaryUpdate]:
    operation = {a.name: a.operation for a in config.aggregations}
    return [u for u in config.summary_updates if (operation[u.source], u.operation) not in SAME_AS_SOURCE]


def merges_across(config: QueryConfig) -> dict[str, str]:
    merges = {p.name: p.across for p in parts_of(config)}
    merges |= {f"__u_{u.target}": UPDATE_MERGES[u.operation] for u in _own_updates(config)}
    return merges


def needs_ticks(config: QueryConfig) -> bool:
    """Whether the final values depend on the results of single ticks."""
    return bool(_own_updates(config)) or any(a.operation == "none" for a in config.aggregations)


def prepared(tick_parts: DataFrame, config: QueryConfig) -> DataFrame:
    """Tick parts made ready to merge across ticks."""
    by_name = {a.name: a for a in config.aggregations}
    columns = {}
    for update in _own_updates(config):
        value = finished(by_name[update.source], latest_as_struct=False)
        if update.operation == "replace":
            value = F.struct(F.col(TICK).alias("tick"), value.alias("value"))
        columns[f"__u_{update.target}"] = value
    columns |= stamp_latest(parts_of(config), F.col(TICK))
    return tick_parts.withColumns(columns) if columns else tick_parts


def snapshot(tick_parts: DataFrame, config: QueryConfig) -> DataFrame:
    """The newest cumulative row of every group, as parts."""
    merges = merges_across(config)
    return prepared(tick_parts, config).groupBy(*config.group_by).agg(
        *(merge_column(kind, c).alias(c) for c, kind in merges.items())
    )


def sparse_history(tick_parts: DataFrame, config: QueryConfig) -> DataFrame:
    """One cumulative row per tick and group that had rows at the tick, as parts."""
    return running(prepared(tick_parts, config), list(config.group_by), TICK, merges_across(config))


def dense_history(tick_parts: DataFrame, config: QueryConfig, ticks: DataFrame) -> DataFrame:
    """Every group seen so far at every due tick, as parts.

    Each changed row is repeated up to the group's next change, so the work follows the output.
    A query without group keys has a row at every due tick, also before its first data.
    """
    keys, merges = list(config.group_by), merges_across(config)
    rows = with_ordinal(prepared(tick_parts, config), ticks)
    if not keys:
        start = ticks.where(F.col("ord") == 1).select("ord")
        rows = (
            rows.unionByName(start, allowMissingColumns=True)
            .groupBy("ord")
            .agg(*(merge_column(kind, c).alias(c) for c, kind in merges.items()))
        )
    newest = last_ordinal(ticks)
    changed = running(rows, keys, "ord", merges, next_position="__next")
    ranged = changed.withColumns(
        {"__first": F.col("ord"), "__stop": F.coalesce(F.col("__next") - 1, F.lit(newest))}
    ).drop("ord", "__next")
    return repeat_over(ranged, "__first", "__stop", ticks)


def finish(
    merged: DataFrame, config: QueryConfig, latest_as_struct: bool = True, helpers: bool = False
) -> DataFrame:
    """Turn merged parts into the query's columns: keys, tick if any, aggregates, targets, metrics.

    With ``helpers`` each average is followed by its row count, which :func:`merge_snapshots` needs.
    """
    lead = [c for c in (TICK,) if c in merged.columns] + list(config.group_by)
    values = []
    for agg in config.aggregations:
        values.append(finished(agg, latest_as_struct))
        if helpers and agg.operation == "avg" and not agg.count_field:
            values.append(row_count(agg).alias(count_name(agg)))
    own = {u.target for u in _own_updates(config)}
    for u in config.summary_updates:
        if u.target in own:
            column = F.col(f"__u_{u.target}")
            values.append((column["value"] if u.operation == "replace" else column).alias(u.target))
        else:
            source = next(a for a in config.aggregations if a.name == u.source)
            values.append(finished(source, latest_as_struct).alias(u.target))
    return derived(merged.select(*lead, *values), config, lead)


def derived(rows: DataFrame, config: QueryConfig, lead: list[str]) -> DataFrame:
    """Add the derived metrics; a division by zero gives null."""
    if not config.derived_metrics:
        return rows
    names = [c for c in rows.columns if c not in lead]
    numbers = rows.select(
        *lead,
        F.struct(*names).alias("__kept"),
        *(F.col(c).try_cast("double").alias(c) for c in names),
    )
    metrics = [
        formula_column(m.formula, names).alias(f"__m_{m.name}") for m in config.derived_metrics
    ]
    return numbers.select(*lead, "__kept", *metrics).select(
        *lead, "__kept.*", *(F.col(f"__m_{m.name}").alias(m.name) for m in config.derived_metrics)
    )


def merge_snapshots(previous: DataFrame, current: DataFrame, config: QueryConfig) -> DataFrame:
    """Fold a newer result into an older one, group by group, as one incremental step.

    Both have the query's columns with helper counts.  Groups of either side stay.  Columns that
    the query does not name pass through; where both sides have one, the older value stays.
    """
    keys = list(config.group_by)
    extra = [
        c for c in dict.fromkeys([*previous.columns, *current.columns])
        if c not in keys and c not in _result_columns(config)
    ]
    old = previous.select(*(F.col(c).alias(f"__o_{c}") for c in previous.columns), F.lit(True).alias("__old"))
    new = current.select(*(F.col(c).alias(f"__n_{c}") for c in current.columns), F.lit(True).alias("__new"))
    same = F.lit(True)
    for k in keys:
        same = same & old[f"__o_{k}"].cast("string").eqNullSafe(new[f"__n_{k}"].cast("string"))
    both = old.join(new, same, "full_outer")

    def side(prefix: str, name: str):
        return F.col(f"__{prefix}_{name}") if f"__{prefix}_{name}" in both.columns else F.lit(None)

    def total(name: str):
        return F.coalesce(side("o", name), F.lit(0)) + F.coalesce(side("n", name), F.lit(0))

    out = [F.when(F.col("__new"), side("n", k)).otherwise(side("o", k)).alias(k) for k in keys]
    for agg in config.aggregations:
        before, now = side("o", agg.name), side("n", agg.name)
        if agg.operation in ("sum", "count"):
            value = total(agg.name)
        elif agg.operation == "min":
            value = F.least(before, now)
        elif agg.operation == "max":
            value = F.greatest(before, now)
        elif agg.operation == "avg":
            counts = count_name(agg)
            weighed = sum(
                F.coalesce(side(p, agg.name) * side(p, counts), F.lit(0.0)) for p in ("o", "n")
            )
            value = F.coalesce(F.try_divide(weighed, total(counts)), F.lit(0.0))
        else:
            value = F.when(F.col("__new"), now).otherwise(before)
        out.append(value.alias(agg.name))
        if agg.operation == "avg" and not agg.count_field:
            out.append(total(count_name(agg)).alias(count_name(agg)))
    out += [F.coalesce(side("o", c), side("n", c)).alias(c) for c in extra]
    return both.select(*out)


def _result_columns(config: QueryConfig) -> set[str]:
    names = {a.name for a in config.aggregations}
    return names | {count_name(a) for a in config.aggregations if a.operation == "avg"}


def stored(rows: DataFrame, config: QueryConfig) -> DataFrame:
    """Only the columns the config asks its history to keep."""
    if not config.store_fields:
        return rows
    kept = [f for f in config.store_fields if f in rows.columns]
    return rows.select(*([TICK] if TICK in rows.columns and TICK not in kept else []), *kept)
