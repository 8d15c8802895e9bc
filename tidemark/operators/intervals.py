"""Rows that stay valid over a range of ticks.

Positions here are ordinals of due ticks, so every integer in a range is an output tick.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import TICK
from tidemark.functions.aggregates import combine, merge_column
from tidemark.operators.scan import BLOCK, running

# Ticks of a stretch: a row of the directory, and what one row opens at a time.
STRETCH = 1 << 8


def directory(ticks: DataFrame) -> DataFrame:
    """The numbered ticks as one row per stretch of ordinals: an array that leads from ordinal to tick."""
    stretch = F.floor((F.col("ord") - 1) / STRETCH).alias("__stretch")
    found = ticks.groupBy(stretch).agg(F.array_sort(F.collect_list(F.struct("ord", TICK))).alias("__ticks"))
    return found.select("__stretch", F.col("__ticks")[TICK].alias("__ticks"))


def repeat_over(df: DataFrame, first: str, last: str, ticks: DataFrame) -> DataFrame:
    """One copy of each row per tick whose ordinal lies in ``[first, last]``.

    Ranges are cut at the ends of stretches and dealt out to all tasks; each piece takes its stretch's
    array of ticks along and opens it in place, so the opened rows are never shuffled.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    low = F.floor((F.col(first) - 1) / STRETCH)
    high = F.floor((F.col(last) - 1) / STRETCH)
    kept = [c for c in df.columns if c not in (first, last, "ord", TICK)]
    cut = (
        df.where(F.col(first) <= F.col(last))
        .withColumn("__stretch", F.explode(F.sequence(low, high)))
        .repartition(tasks)
    )
    before = F.col("__stretch") * STRETCH
    start = F.greatest(F.col(first) - before, F.lit(1)).cast("int")
    stop = F.least(F.col(last) - before, F.lit(STRETCH)).cast("int")
    held = cut.join(directory(ticks), "__stretch")
    return held.select(F.explode(F.slice("__ticks", start, stop - start + 1)).alias(TICK), *kept).select(*kept, TICK)


def sliding_over(
    df: DataFrame, keys: list[str], merges: dict[str, str], width: int, ticks: DataFrame, newest: int
) -> DataFrame:
    """Per due tick and group, merge the rows at the last ``width`` positions before the tick's point.

    A row stands at position ``__at``; it enters at the due tick of ordinal ``__in`` and point ``__in_at``
    and has left at ``__out`` (``__out_at``; null: never).  Positions are cut into blocks of ``width``, so a
    window is the end of one block and the beginning of the next.  Every row takes part in its own block, for
    windows that reach it from the block's beginning, and in the next one, for windows that end there; one
    shuffle by group and block serves a running merge in each direction.  A group's result only changes where
    rows enter or leave, so it is found there and repeated up to the group's next change.
    """
    at, enters, leaves = F.col("__at"), F.col("__in_at"), F.col("__out_at")

    def role(kind: int, block: Column, forward: Column, backward: Column, ordinal: Column) -> Column:
        fields = {"kind": F.lit(kind), "block": block, "ahead": forward, "back": backward, "ord": ordinal}
        return F.struct(*(c.cast("long").alias(name) for name, c in fields.items()))

    def block_of(position: Column) -> Column:
        return F.floor(position / F.lit(width))

    none = F.lit(None)
    roles = [
        role(0, block_of(at), at, -at, none),
        role(1, block_of(at) + 1, at + width, -(at + width), none),
        role(2, block_of(enters), enters, -enters - 1, F.col("__in")),
        F.when(F.col("__out").isNotNull(), role(2, block_of(leaves), leaves, -leaves - 1, F.col("__out"))),
    ]
    merges = {**merges, "__rows": "sum"}
    dealt = df.withColumn("__rows", F.lit(1).cast("long")).select(*keys, *merges, F.explode(F.array(*roles)).alias("__role"))
    dealt = dealt.where(F.col("__role").isNotNull()).select(*keys, "__role.*", *merges)
    sides = {0: ("head", "ahead"), 1: ("tail", "back")}
    for kind, (name, _) in sides.items():
        dealt = dealt.withColumns({f"__{name}_{c}": F.when(F.col("kind") == kind, F.col(c)) for c in merges})
    dealt = dealt.drop(*merges)
    for name, position in sides.values():
        dealt = _along(dealt, [*keys, "block"], position, {f"__{name}_{c}": m for c, m in merges.items()}, width)
    values = [combine(m, F.col(f"__tail_{c}"), F.col(f"__head_{c}")).alias(c) for c, m in merges.items()]
    points = dealt.where(F.col("kind") == 2).select(*keys, "ord", *values)
    # Points of one ordinal are equal; all but the last of them end before they begin.
    nexts = running(points, keys, "ord", {}, next_position="__next").where(F.col("__rows") > 0)
    stop = F.coalesce(F.col("__next") - 1, F.lit(newest).cast("long"))
    return repeat_over(nexts.withColumns({"__first": F.col("ord"), "__stop": stop}).drop("__next", "__rows"), "__first", "__stop", ticks)


def _along(df: DataFrame, by: list[str], position: str, merges: dict[str, str], width: int) -> DataFrame:
    """Running merges within a block of ``width`` positions, which is cut once more where it is long."""
    if width > BLOCK:
        return running(df, by, position, merges)
    so_far = Window.partitionBy(*by).orderBy(position).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: merge_column(kind, c).over(so_far) for c, kind in merges.items()})


def aggregate_over(
    df: DataFrame,
    keys: list[str],
    first: str,
    last: str,
    merges: dict[str, str],
    ticks: DataFrame,
    longest: int,
) -> DataFrame:
    """Per tick and group, merge all rows whose range ``[first, last]`` holds the tick's ordinal.

    A range splits into at most two aligned power-of-two pieces per size, and a tick lies in one
    piece of each size.  Rows are merged per piece first; then every tick reads the pieces above
    it.  Work is rows x log(longest range) plus groups present x log(longest range), and min and
    max are as exact as sums.  No range may hold more than ``longest`` ordinals.
    """
    levels = max(longest, 1).bit_length()
    pieces = []
    for k in range(levels):
        left = F.shiftright(F.col(first) + F.lit((1 << k) - 1), k)
        right = F.shiftright(F.col(last) + F.lit(1), k)
        odd = left < right
        pieces.append(F.when(odd & (left.bitwiseAND(1) == 1), _piece(k, left)))
        pieces.append(F.when(odd & (right.bitwiseAND(1) == 1), _piece(k, right - 1)))

    nodes = (
        df.where(F.col(first) <= F.col(last))
        .select(*keys, *merges, F.explode(F.array(*pieces)).alias("__piece"))
        .where(F.col("__piece").isNotNull())
        .groupBy(*keys, "__piece")
        .agg(*(merge_column(kind, c).alias(c) for c, kind in merges.items()))
    )
    above = F.array(*(_piece(k, F.shiftright("ord", k)) for k in range(levels)))
    readers = ticks.select(TICK, F.explode(above).alias("__piece"))
    return (
        readers.join(nodes, "__piece")
        .groupBy(TICK, *keys)
        .agg(*(merge_column(kind, c).alias(c) for c, kind in merges.items()))
    )


def _piece(level: int, node: Column) -> Column:
    """One number for an aligned piece of ``2**level`` ordinals; ordinals stay far below 2**40."""
    return node + F.lit(level << 40)
