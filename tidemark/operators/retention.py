"""What a stream keeps, and aggregates over windows of ticks or rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import TICK, QueryConfig, WindowSpec
from tidemark.functions.aggregates import merge_column, parts_of
from tidemark.operators.evaluate import selected
from tidemark.operators.landmark import finish
from tidemark.operators.positions import positioned
from tidemark.operators.scan import running

# the age of rows without a tick: older than any 32-bit tick
OLDEST = 1 << 40


def retained(df: DataFrame, window: WindowSpec, key: str) -> DataFrame:
    """The rows a stream still holds after trimming at its newest tick.

    By time the last ``size`` ticks before the newest stay, both ends included.  By rows the
    newest ``size`` rows stay; among rows of one tick the larger key counts as newer.
    """
    if window.by_time:
        oldest = df.agg(F.max(TICK) - F.lit(window.size)).scalar()
        return df.where(F.col(TICK) >= oldest)
    return newest_rows(df, window.size, key) if window.by_rows else df


def _age(tick) -> Column:
    return F.coalesce(-tick.cast("long"), F.lit(OLDEST))


def _cut(df: DataFrame, size: int):
    """The age at which the newest ``size`` rows end, the rows of that age, and the rows up to it; None if all stay."""
    counts = df.groupBy(_age(F.col(TICK)).alias("age")).agg(F.count("*").alias("own"))
    summed = running(counts.withColumn("n", F.col("own")), [], "age", {"n": "sum"}).where(F.col("n") >= size)
    return summed.agg(F.min_by(F.struct("age", "own", "n"), "age").alias("cut")).first()["cut"]


def newest_rows(df: DataFrame, size: int, key: str) -> DataFrame:
    """Whole ticks above the cut-off, and the newest rows of the one tick that is split.

    Rows without a tick are the oldest.
    """
    cut = _cut(df, size)
    if cut is None:
        return df
    age = _age(F.col(TICK))
    older = cut["n"] - size
    edge = positioned(df.where(age == cut["age"]), [key], "__pos").where(F.col("__pos") > older).drop("__pos")
    return df.where(age < cut["age"]).unionByName(edge)


def evicted(df: DataFrame, window: WindowSpec, key: str) -> DataFrame:
    """The rows trimming removes: those before the cut that :func:`retained` keeps from."""
    if window.by_time:
        return df.where(F.col(TICK) < df.agg(F.max(TICK) - F.lit(window.size)).scalar())
    cut = _cut(df, window.size) if window.by_rows else None
    if cut is None:
        return df.where(F.lit(False))
    age = _age(F.col(TICK))
    older = cut["n"] - window.size
    edge = positioned(df.where(age == cut["age"]), [key], "__pos").where(F.col("__pos") <= older).drop("__pos")
    return df.where(age > cut["age"]).unionByName(edge)


def aligned(df: DataFrame, config: QueryConfig, window: WindowSpec, key: str | None = None) -> DataFrame:
    """Aggregate per true window: fixed starts, each ``size`` long, one every ``slide``.

    By time, windows start at multiples of the slide and rows are merged per tick first.  By
    rows, each run of ``size`` rows in tick order is a window.  With a slide longer than the
    size some ticks fall in no window.
    """
    parts, keys = parts_of(config), list(config.group_by)
    merged = [merge_column(p.within, p.name).alias(p.name) for p in parts]
    if window.by_rows:
        fields = {p.field for p in parts if p.field != "*"} | {f.field for f in config.filters}
        rows = df.select(*sorted(fields | {*keys, TICK, key}))
        numbered = positioned(rows, [TICK, key], "__pos").withColumn(
            "window_start", F.floor((F.col("__pos") - 1) / F.lit(window.size)) * F.lit(window.size)
        )
        out = selected(numbered, config).groupBy("window_start", *keys).agg(*(p.of_rows() for p in parts))
    else:
        slide = window.slide or window.size
        per_tick = (
            selected(df, config).where(F.col(TICK).isNotNull())
            .groupBy(F.col(TICK).cast("long").alias(TICK), *keys)
            .agg(*(p.of_rows() for p in parts))
        )
        first = F.floor((F.col(TICK) - F.lit(window.size)) / F.lit(slide)) + 1
        last = F.floor(F.col(TICK) / F.lit(slide))
        out = (
            per_tick.where(first <= last)
            .withColumn("__window", F.explode(F.sequence(first, last)))
            .withColumn("window_start", F.col("__window") * F.lit(slide))
            .groupBy("window_start", *keys)
            .agg(*merged)
        )
    values = finish(out.withColumnRenamed("window_start", TICK), config, latest_as_struct=False)
    return values.withColumnRenamed(TICK, "window_start")


def newest_ticks(series: DataFrame, window: int = 60, floor_at_zero: bool = False) -> DataFrame:
    """The part of a series within ``window`` ticks of its newest one, both ends included."""
    oldest = F.max(TICK) - F.lit(window)
    if floor_at_zero:
        oldest = F.greatest(oldest, F.lit(0))
    return series.where(F.col(TICK) >= series.agg(oldest).scalar())
