"""What one tick's query returns, for every due tick at once.

A query sees the rows its stream still holds at the tick.  Each row is therefore visible over a
range of ticks: from its own tick until retention drops it, narrowed by any filter that compares
a field with the current tick.  Three shapes follow:

* exactly one tick (``ts = {CURRENT_TICK}``): a plain grouping by tick;
* open-ended (everything is kept): a running aggregate;
* the last ticks or the last rows: :func:`sliding_over`;
* any other range, which a comparison of the tick with another field gives: :func:`aggregate_over`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import TICK, QueryConfig, WindowSpec
from tidemark.functions.aggregates import merge_column, parts_of
from tidemark.functions.predicates import number, row_condition, validity
from tidemark.operators.clock import due_up_to, last_ordinal, next_due
from tidemark.operators.intervals import aggregate_over, repeat_over, sliding_over
from tidemark.operators.positions import positioned
from tidemark.operators.scan import BLOCK, join_on, running
from tidemark.session import settled

FOREVER = (1 << 62) - 1
# up to this rank Spark prunes row numbers before the shuffle
PRUNED = 1000


def at_one_tick(config: QueryConfig) -> bool:
    return any(f.field == TICK and f.operator == "=" and f.on_tick for f in config.filters)


def selected(df: DataFrame, config: QueryConfig) -> DataFrame:
    """The rows that pass the filters against constants."""
    condition = row_condition(config.filters, df.schema)
    return df if condition is None else df.where(condition)


def pinned_rows(df: DataFrame, config: QueryConfig) -> DataFrame:
    """The rows a query pinned to the current tick reads, each at its own tick."""
    rows = selected(df, config).where(F.col(TICK).isNotNull())
    for f in config.filters:
        if f.on_tick and f.field != TICK:
            rows = rows.where(_holds_at_own_tick(f))
        elif f.on_tick and f.operator not in ("=", "<=", ">="):
            rows = rows.where(F.lit(False))
    return rows


def per_tick(df: DataFrame, config: QueryConfig) -> DataFrame:
    """Parts per tick and group, for queries that only look at the current tick's rows."""
    tick = F.col(TICK).cast("long").alias(TICK)
    return pinned_rows(df, config).groupBy(*config.group_by, tick).agg(
        *(p.of_rows() for p in parts_of(config))
    )


def _holds_at_own_tick(f):
    field = number(F.col(f.field))
    return {
        "=": field == F.col(TICK),
        "<": field < F.col(TICK),
        "<=": field <= F.col(TICK),
        ">": field > F.col(TICK),
        ">=": field >= F.col(TICK),
    }.get(f.operator, field != F.col(TICK))


def moves_with_tick(config: QueryConfig) -> bool:
    """Whether all rows of a tick pass the comparisons with the current tick together."""
    return all(f.field == TICK for f in config.filters if f.on_tick)


def parts_by_own_tick(df: DataFrame, config: QueryConfig) -> DataFrame:
    """Parts per group and the rows' own tick, whichever ticks they are visible at."""
    rows = selected(df, config).where(F.col(TICK).isNotNull())
    return rows.groupBy(*config.group_by, F.col(TICK).cast("long").alias(TICK)).agg(
        *(p.of_rows() for p in parts_of(config))
    )


def over_retained(
    rows: DataFrame,
    config: QueryConfig,
    window: WindowSpec,
    ticks: DataFrame,
    key: str | None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Parts per due tick and group over the rows retained at that tick.

    ``ticks`` are the numbered due ticks.  ``rows`` are stream rows, or for time windows and
    everything-kept may be :func:`parts_by_own_tick`.  ``key`` is the stream's primary key; it
    orders rows of one tick in a row-count window.  ``counts`` are the stream's rows per tick where
    ``rows`` are only the newest of every tick (:func:`newest_of_ticks`).
    """
    parts = parts_of(config)
    keys = list(config.group_by)
    merges = {p.name: p.within for p in parts}
    if window.by_rows and not any(f.on_tick for f in config.filters):
        return _over_newest_rows(rows, config, window.size, ticks, key, counts)
    if window.by_time and moves_with_tick(config):
        return _over_newest_ticks(rows, config, window.size, ticks)
    due = last_ordinal(ticks)
    n_due = F.lit(due).cast("long")
    merged_rows = all(p.name in rows.columns for p in parts)

    last = F.lit(FOREVER)
    held = []
    if window.by_rows:
        wanted = {*keys, *(p.field for p in parts if p.field != "*"), *(f.field for f in config.filters)}
        rows = rows.where(F.col(TICK).isNotNull()).select(*sorted(wanted | {TICK, key}))
        rows = selected(_last_due_by_rows(rows, window.size, ticks, key, counts), config)
        held = ["__last"]
    else:
        if window.by_time:
            last = F.col(TICK).cast("long") + F.lit(window.size)
        if not merged_rows:
            rows = selected(rows, config).where(F.col(TICK).isNotNull())
    first = F.col(TICK).cast("long")
    ranges = rows.withColumn("__range", F.explode(validity(config.filters, first, last)))
    ranged = ranges.withColumns({"__lo": F.col("__range.lo"), "__hi": F.col("__range.hi")}).where(
        F.col("__lo") <= F.col("__hi")
    )
    if merged_rows:
        ranged = ranged.select(*keys, "__lo", "__hi", *merges)
    else:
        ranged = settled(
            ranged.groupBy(*keys, "__lo", "__hi", *held).agg(*(p.of_rows() for p in parts)), "ranged"
        )
    # Points outside the due ticks are cut to their ends, so there are no more than ticks between them.
    edges = ticks.agg(F.min(TICK).alias("first"), F.max(TICK).alias("last")).first()
    oldest, newest = (edges["first"] or 0) - 1, edges["last"] or 0
    ranged = ranged.where((F.col("__lo") <= newest) & (F.col("__hi") > oldest)).withColumn(
        "__before", F.greatest(F.col("__lo") - 1, F.lit(oldest))
    )
    ends = ranged.where(F.col("__hi") < newest).select(F.col("__hi").alias("point"))
    starts = ranged.select(F.col("__before").alias("point"))
    upto = settled(due_up_to(starts.unionByName(ends).distinct(), ticks), "upto")
    ranged = join_on(
        ranged, upto.select(F.col("point").alias("__before"), F.col("upto").alias("__n_before")), ["__before"]
    )
    # Rows that stay to the end need no look-up, and would all meet in one key.
    to_end = ranged.where(F.col("__hi") >= newest).withColumn("__n_end", n_due)
    ending = upto.select(F.col("point").alias("__hi"), F.col("upto").alias("__n_end"))
    ranged = join_on(ranged.where(F.col("__hi") < newest), ending, ["__hi"], "inner").unionByName(to_end)
    ranged = ranged.withColumns(
        {
            "__first": F.col("__n_before") + 1,
            "__stop": F.least(F.col("__n_end"), F.col("__last")) if held else F.col("__n_end"),
        }
    ).where(F.col("__first") <= F.col("__stop"))

    open_ended = not window.by_rows and not window.by_time and all(
        f.operator in ("<", "<=") for f in config.filters if f.on_tick
    )
    if open_ended:
        arrived = ranged.groupBy(*keys, "__first").agg(
            *(merge_column(kind, c).alias(c) for c, kind in merges.items())
        )
        totals = running(arrived, keys, "__first", merges, next_position="__next")
        totals = totals.withColumn("__stop", F.coalesce(F.col("__next") - 1, n_due)).drop("__next")
        return repeat_over(totals, "__first", "__stop", ticks)
    # a time window cannot span more due ticks than ticks
    longest = min(window.size + 1, due) if window.by_time else due
    return aggregate_over(ranged, keys, "__first", "__stop", merges, ticks, longest)


def visible_after(config: QueryConfig, size: int) -> tuple[int, int]:
    """How many ticks after its own a row is visible, first and last, where filters only compare its tick."""
    low, high = 0, size
    for f in config.filters:
        if f.on_tick and f.operator in ("<", "!=", "<>"):
            low = max(low, 1)
        elif f.on_tick and f.operator in ("=", ">="):
            high = min(high, 0)
        elif f.on_tick and f.operator == ">":
            high = min(high, -1)
    return low, high


def _over_newest_ticks(rows: DataFrame, config: QueryConfig, size: int, ticks: DataFrame) -> DataFrame:
    """Parts per due tick and group over the last ticks; every row is visible equally long."""
    keys, merges = list(config.group_by), {p.name: p.within for p in parts_of(config)}
    if not all(c in rows.columns for c in merges):
        rows = settled(parts_by_own_tick(rows, config), "parts")
    low, high = visible_after(config, size)
    edges = ticks.agg(F.min(TICK).alias("first"), F.max(TICK).alias("last"), F.max("ord").alias("n")).first()
    oldest, newest = edges["first"] or 0, edges["last"] or 0
    width = high - low + 1
    at = F.col(TICK).cast("long") + low
    placed = rows.select(*keys, *merges, at.alias("__at"), (at + width).alias("__end"))
    placed = placed.where((F.col("__end") > oldest) & (F.col("__at") <= newest) & F.lit(width > 0))
    placed = placed.withColumn("__from", F.greatest("__at", F.lit(oldest)))
    points = placed.select(F.col("__from").alias("point")).unionByName(
        placed.where(F.col("__end") <= newest).select(F.col("__end").alias("point"))
    )
    found = settled(next_due(points.distinct(), ticks), "next")
    entering = found.select(F.col("point").alias("__from"), F.col("ord").alias("__in"), F.col("ord_at").alias("__in_at"))
    leaving = found.select(F.col("point").alias("__end"), F.col("ord").alias("__out"), F.col("ord_at").alias("__out_at"))
    placed = placed.join(entering, "__from").join(leaving, "__end", "left").drop("__from", "__end")
    placed = placed.where(F.col("__out").isNull() | (F.col("__in") < F.col("__out")))
    return sliding_over(placed, keys, merges, max(width, 1), ticks, edges["n"] or 0)


def rows_per_tick(rows: DataFrame) -> DataFrame:
    """The number of rows (``n``) of every tick; adds up over batches."""
    return rows.where(F.col(TICK).isNotNull()).groupBy(F.col(TICK).cast("long").alias(TICK)).agg(F.count("*").alias("n"))


def newest_of_ticks(rows: DataFrame, config: QueryConfig, size: int, key: str) -> DataFrame:
    """The rows that a window of the newest ``size`` rows may still show, with the columns the query reads.

    Of every tick the newest ``size``; the newest of a union are among the newest of its parts, so batches can be
    stored one by one.  Windows of more than ``PRUNED`` rows keep all.
    """
    parts = parts_of(config)
    wanted = {*config.group_by, *(p.field for p in parts if p.field != "*"), *(f.field for f in config.filters)}
    rows = rows.where(F.col(TICK).isNotNull()).select(*sorted(wanted | {TICK, key}))
    if size > PRUNED:
        return rows
    newest = Window.partitionBy(TICK).orderBy(F.col(key).desc())
    return rows.withColumn("__rank", F.row_number().over(newest)).where(F.col("__rank") <= size).drop("__rank")


def _over_newest_rows(
    rows: DataFrame, config: QueryConfig, size: int, ticks: DataFrame, key: str, counts: DataFrame | None
) -> DataFrame:
    """Parts per due tick and group over the newest ``size`` rows.

    Rows are numbered in tick and key order; a due tick's point is the number of rows up to it, and its window
    is the last ``size`` numbers.  A row's number is the count up to its tick less its rank from the tick's end.
    Up to ``PRUNED`` rows, Spark drops all but the newest ``size`` of every tick before its shuffle; larger
    windows number all rows by a range sort.
    """
    parts = parts_of(config)
    keys, merges = list(config.group_by), {p.name: p.within for p in parts}
    wanted = {*keys, *(p.field for p in parts if p.field != "*"), *(f.field for f in config.filters)}
    rows = rows.where(F.col(TICK).isNotNull()).select(*sorted(wanted | {TICK, key}))
    held = _rows_up_to(rows_per_tick(rows) if counts is None else counts, ticks)
    counted = held.select(F.col(TICK).alias("__tick"), "__held", "__in", "__in_at")
    same = F.col(TICK).cast("long") == F.col("__tick")
    if size <= PRUNED:
        newest = Window.partitionBy(TICK).orderBy(F.col(key).desc())
        ranked = rows.withColumn("__rank", F.row_number().over(newest)).where(F.col("__rank") <= size)
        placed = ranked.join(counted, same).withColumn("__at", F.col("__held") - F.col("__rank") + 1)
    else:
        placed = positioned(rows, [TICK, key], "__at").join(counted, same)
    # The due tick at which a row has left: the first whose point is ``size`` numbers further on.
    placed = selected(placed, config).where(F.col("__in").isNotNull())
    due = held.where(F.col("ord").isNotNull())
    spread = due.agg(F.max("__held").alias("rows"), F.max("ord").alias("ord")).first()
    points = due.groupBy((-F.col("__held")).alias("__back")).agg(F.min("ord").alias("__out"))
    points = points.withColumn("__out_at", -F.col("__back"))
    queued = placed.withColumn("__back", -(F.col("__at") + size)).unionByName(points, allowMissingColumns=True)
    block = max(BLOCK, (spread["rows"] or 0) >> 16)
    left = running(queued, [], "__back", {"__out": "min", "__out_at": "min"}, block=block).where(F.col("__at").isNotNull())
    left = left.where(F.col("__out").isNull() | (F.col("__in") < F.col("__out")))
    alike = left.groupBy(*keys, "__in", "__in_at", "__out", "__out_at").agg(
        F.min("__at").alias("__at"), *(p.of_rows() for p in parts)
    )
    return sliding_over(alike, keys, merges, size, ticks, spread["ord"] or 0)


def _rows_up_to(counts: DataFrame, ticks: DataFrame) -> DataFrame:
    """Per tick of rows or clock: the number of rows up to it, its ordinal if due, and the first due tick from it on."""
    marks = (
        counts.select(F.col(TICK).cast("long").alias(TICK), F.col("n").alias("__held"), F.lit(None).cast("long").alias("ord"))
        .unionByName(ticks.select(TICK, F.lit(0).cast("long").alias("__held"), "ord"))
        .groupBy(TICK)
        .agg(F.sum("__held").alias("__held"), F.max("ord").alias("ord"))
    )
    counted = running(marks, [], TICK, {"__held": "sum"})
    due = {"__in": F.col("ord"), "__in_at": F.when(F.col("ord").isNotNull(), F.col("__held"))}
    found = running(counted.withColumns({"__back": -F.col(TICK), **due}), [], "__back", {c: "min" for c in due})
    return settled(found.drop("__back"), "held")


def _last_due_by_rows(rows: DataFrame, size: int, ticks: DataFrame, key: str, counts: DataFrame | None) -> DataFrame:
    """Attach to each row the ordinal (``__last``) of the last due tick whose newest ``size`` rows hold it.

    The row at position p of all rows in tick and key order is among the newest ``size`` at a tick as long
    as no more than p + size - 1 rows lie at or before that tick.  Up to ``PRUNED`` rows, only the newest
    ``size`` of every tick can ever be held, and Spark drops the others before its shuffle; larger
    windows number all rows by a range sort.
    """
    tick = F.col(TICK).cast("long")
    counts = rows_per_tick(rows) if counts is None else counts
    marks = (
        counts.select(F.col(TICK).cast("long").alias(TICK), F.col("n").alias("__held"), F.lit(None).cast("long").alias("ord"))
        .unionByName(ticks.select(TICK, F.lit(None).cast("long").alias("__held"), "ord"))
        .groupBy(TICK)
        .agg(F.sum("__held").alias("__held"), F.max("ord").alias("ord"))
    )
    held = settled(running(marks, [], TICK, {"__held": "sum"}), "held")
    n_rows = held.agg(F.max("__held")).first()[0] or 0
    if size <= PRUNED:
        newest = Window.partitionBy(TICK).orderBy(F.col(key).desc())
        kept = rows.withColumn("__rank", F.row_number().over(newest)).where(F.col("__rank") <= size)
        placed = join_on(kept, held.select(TICK, "__held"), [TICK], "inner").withColumn(
            "__reach", F.col("__held") - F.col("__rank") + F.lit(size)
        ).drop("__held", "__rank")
    else:
        placed = positioned(rows, [TICK, key], "__pos").withColumn(
            "__reach", F.col("__pos") + F.lit(size - 1)
        ).drop("__pos")
    placed = settled(placed, "placed")
    wanted = placed.select("__reach").distinct().withColumn("ord", F.lit(None).cast("long"))
    steps = held.where(F.col("ord").isNotNull()).select(F.coalesce("__held", F.lit(0)).alias("__reach"), "ord")
    reached = wanted.unionByName(steps).groupBy("__reach").agg(F.max("ord").alias("__last"))
    last = running(reached, [], "__reach", {"__last": "max"}, block=max(BLOCK, n_rows >> 16))
    return join_on(placed, last, ["__reach"], "inner").drop("__reach").withColumn(
        "__last", F.coalesce("__last", F.lit(0).cast("long"))
    )
