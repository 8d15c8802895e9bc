"""Running aggregates that never put an unbounded group into one task."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.aggregates import combine, merge_column

# Ticks are 32-bit, so blocks of 2**16 ticks leave at most 2**16 blocks per group: neither
# level of the scan ever sorts more than 2**16 rows of one group in a task.
BLOCK = 1 << 16


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on keys where null equals null, keeping the left side's key columns."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = reduce(and_, (left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys))
    return left.join(renamed, on, how).drop(*(f"__r_{k}" for k in keys))


def running(
    df: DataFrame,
    keys: list[str],
    position: str,
    merges: dict[str, str],
    next_position: str | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """Replace each column of ``merges`` by its running value along ``position`` per group.

    Two levels: within blocks of positions, and over one row per block.  Rows that share a
    position see each other.  ``next_position`` names a column for the group's next position.
    """
    keyed = df.withColumn("__block", F.floor(F.col(position) / F.lit(block)))
    by_block = [*keys, "__block"]

    inside = Window.partitionBy(*by_block).orderBy(position)
    so_far = inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    columns = {c: merge_column(kind, c).over(so_far) for c, kind in merges.items()}
    if next_position:
        columns[next_position] = F.lead(position).over(inside)
    rows = keyed.withColumns(columns)

    totals = keyed.groupBy(*by_block).agg(
        *(merge_column(kind, c).alias(c) for c, kind in merges.items()),
        F.min(position).alias("__first"),
    )
    blocks = Window.partitionBy(*keys).orderBy("__block")
    before = blocks.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by_block,
        *(merge_column(kind, c).over(before).alias(f"__before_{c}") for c, kind in merges.items()),
        F.lead("__first").over(blocks).alias("__next_first"),
    )

    joined = join_on(rows, offsets, by_block)
    merged = {
        c: combine(kind, F.col(f"__before_{c}"), F.col(c)) for c, kind in merges.items()
    }
    if next_position:
        merged[next_position] = F.coalesce(next_position, "__next_first")
    return joined.withColumns(merged).drop(
        "__block", "__next_first", *(f"__before_{c}" for c in merges)
    )
