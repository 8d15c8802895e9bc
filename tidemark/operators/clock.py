"""Logical time: which ticks exist, which are due, and how many lie before a point."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import TICK
from tidemark.operators.scan import BLOCK, join_on, running
from tidemark.session import settled


def ticks_of(*streams: DataFrame) -> DataFrame:
    """The distinct ticks of one or more streams."""
    found = None
    for df in streams:
        one = df.select(F.col(TICK).cast("long").alias(TICK)).where(F.col(TICK).isNotNull()).distinct()
        found = one if found is None else found.unionByName(one).distinct()
    return found


def current_tick(df: DataFrame) -> DataFrame:
    """One row: the newest tick seen."""
    return df.agg(F.max(TICK).alias("current_tick"))


def clock_after_batches(rows: DataFrame, batch: str, is_new: str) -> DataFrame:
    """The clock each batch leaves behind: its newest tick, if it brought any new row."""
    return (
        rows.groupBy(batch)
        .agg(F.max(TICK).alias("tick"), F.max(F.col(is_new).cast("int")).alias("__new"))
        .where(F.col("__new") == 1)
        .select(batch, "tick")
    )


def due_ticks(ticks: DataFrame, frequency: int = 1, skip_tick_zero: bool = False) -> DataFrame:
    """The ticks at which a query runs: the first, then each first tick at least ``frequency`` later.

    The choice at a tick depends on the choice before it.  Ticks are cut into blocks of a fixed width; each
    block tells, for the ticks where a walk can enter it, the tick where that walk enters a later block.
    These maps compose: joined with themselves they lead over 2, 4, 8 ... blocks, and the walk from the first
    tick is read off them from the longest down.  Every block that it enters then marks its own ticks.
    """
    if skip_tick_zero:
        ticks = ticks.where(F.col(TICK) > 0)
    if frequency <= 1:
        return ticks
    blocks = settled(ticks.select(TICK, F.floor(F.col(TICK) / F.lit(BLOCK)).alias("block")), "ticks")
    ends = blocks.agg(F.min(TICK).alias("start"), F.min("block").alias("first"), F.max("block").alias("last")).first()
    start = ends["start"]

    def ways_through(pdf: pd.DataFrame) -> pd.DataFrame:
        at = np.sort(pdf[TICK].to_numpy())
        start = int(pdf["block"].iloc[0]) * BLOCK
        following = np.searchsorted(at, at + frequency)
        last = np.where(following < len(at), following, np.arange(len(at)))
        while True:
            further = last[last]
            if np.array_equal(further, last):
                break
            last = further
        entries = min(int(np.searchsorted(at, start + frequency)) + 1, len(at))
        return pd.DataFrame({"entry": at[:entries], "point": at[last[:entries]] + frequency})

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        at = np.sort(pdf[TICK].to_numpy())
        following = np.searchsorted(at, at + frequency)
        i, due = int(np.searchsorted(at, pdf["entry"].iloc[0])), []
        while i < len(at):
            due.append(at[i])
            i = int(following[i])
        return pd.DataFrame({TICK: np.array(due, dtype="int64")})

    if ends["first"] == ends["last"]:  # nothing to chain
        return blocks.withColumn("entry", F.lit(start).cast("long")).groupBy("block").applyInPandas(walk, f"{TICK} long")
    leaving = settled(blocks.groupBy("block").applyInPandas(ways_through, "entry long, point long"), "ways")
    arriving = next_due(leaving.select("point").distinct(), blocks.select(TICK, F.col(TICK).alias("ord")))
    leads = settled(leaving.join(arriving.where(F.col("ord").isNotNull()), "point").select("entry", F.col("ord").alias("to")), "leads")
    longer = [leads]
    while not longer[-1].where(F.col("entry") == start).isEmpty():
        second = longer[-1].select(F.col("entry").alias("to"), F.col("to").alias("further"))
        longer.append(settled(longer[-1].join(second, "to").select("entry", F.col("further").alias("to")), "leads"))
    entered = blocks.sparkSession.createDataFrame([(start,)], "entry long")
    for leads in reversed(longer[:-1]):
        entered = settled(entered.unionByName(entered.join(leads, "entry").select(F.col("to").alias("entry"))), "entered")
    entries = entered.select("entry", F.floor(F.col("entry") / F.lit(BLOCK)).alias("block"))
    return blocks.join(entries, "block").groupBy("block").applyInPandas(walk, f"{TICK} long")


def numbered(ticks: DataFrame) -> DataFrame:
    """The ticks with their ordinal, from 1, as a settled table."""
    counted = running(ticks.withColumn("ord", F.lit(1).cast("long")), [], TICK, {"ord": "sum"})
    return settled(counted, "ticks")


def last_ordinal(ticks: DataFrame) -> int:
    """How many numbered ticks there are."""
    return ticks.agg(F.max("ord")).first()[0] or 0


def due_up_to(points: DataFrame, due: DataFrame) -> DataFrame:
    """For each distinct ``point``, how many numbered ticks lie at or before it (``upto``)."""
    marks = (
        points.select(F.col("point").cast("long").alias("point"), F.lit(None).cast("long").alias("upto"))
        .unionByName(due.select(F.col(TICK).alias("point"), F.col("ord").alias("upto")))
        .groupBy("point")
        .agg(F.max("upto").alias("upto"))
    )
    counted = running(marks, [], "point", {"upto": "max"})
    return counted.select("point", F.coalesce("upto", F.lit(0).cast("long")).alias("upto"))


def next_due(points: DataFrame, due: DataFrame, at: str = TICK) -> DataFrame:
    """For each distinct ``point``, the ordinal (``ord``) and place (``ord_at``) of the first numbered tick there or later."""
    marks = points.select(F.col("point").cast("long").alias("point"), F.lit(None).cast("long").alias("ord"))
    marks = marks.unionByName(due.select(F.col(at).cast("long").alias("point"), F.col("ord").cast("long").alias("ord")))
    marks = marks.groupBy("point").agg(F.min("ord").alias("ord"))
    marks = marks.withColumns({"ord_at": F.when(F.col("ord").isNotNull(), F.col("point")), "__back": -F.col("point")})
    return running(marks, [], "__back", {"ord": "min", "ord_at": "min"}).drop("__back")


def with_ordinal(df: DataFrame, ticks: DataFrame, tick: str = TICK) -> DataFrame:
    """Attach the ordinal of each row's tick; rows at other ticks are dropped."""
    return join_on(df, ticks.select(F.col(TICK).alias(tick), "ord"), [tick], "inner")
