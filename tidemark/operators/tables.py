"""Keyed tables: views, newest rows, first-wins, upserts, audits, schema growth."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import TICK
from tidemark.operators.scan import join_on
from tidemark.sources.schemas import FOREIGN_KEYS, SUMMARY_KEY

# the columns the three table views show; the command view labels its signal as intersection
VIEWS = {
    "sensor_stream": ("pkt_id", "ts", "intersection_id", "road_id", "avg_speed AS speed", "occupancy"),
    "event_stream": ("event_id AS evt_id", "ts", "road_id", "event_type"),
    "command_stream": ("cmd_id", "ts", "signal_id AS intersection_id", "action", "reason"),
}


def table_view(df: DataFrame, source: str) -> DataFrame:
    return df.selectExpr(*VIEWS[source])


def newest(df: DataFrame, key: str, n: int = 1000) -> DataFrame:
    """The ``n`` newest rows; rows of one tick in key order."""
    return df.orderBy(F.col(TICK).desc(), F.col(key)).limit(n)


def first_wins(df: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """One row per key: the first along ``arrival``, which must be a total order.

    The rank limit is applied before the shuffle, so a key with very many copies sends one row
    per task.
    """
    order = Window.partitionBy(*keys).orderBy(*arrival)
    return df.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") == 1).drop("__rank")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Insert or replace by key: of all rows with a key the one with the highest version stays.

    At the same version the new row wins.
    """
    columns = old.columns
    values = F.struct(*(c for c in columns if c not in keys))
    both = old.withColumn("__new", F.lit(0)).unionByName(new.select(*columns).withColumn("__new", F.lit(1)))
    picked = both.groupBy(*keys).agg(F.max_by(values, F.struct(version, "__new")).alias("__row"))
    return picked.select(*keys, "__row.*").select(*columns)


def fill_missing(old: DataFrame, new: DataFrame, keys: Sequence[str], kept: Sequence[str]) -> DataFrame:
    """Insert or update by key, except that ``kept`` columns change only where they were null."""
    other = new.select(*keys, *(F.col(c).alias(f"__n_{c}") for c in new.columns if c not in keys))
    joined = old.withColumn("__old", F.lit(True)).join(other.withColumn("__new", F.lit(True)), list(keys), "full_outer")
    out = []
    for c in old.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in kept:
            out.append(F.coalesce(c, f"__n_{c}").alias(c))
        else:
            out.append(F.when(F.col("__new"), F.col(f"__n_{c}")).otherwise(F.col(c)).alias(c))
    return joined.select(*out)


def summary_lookup(summary: DataFrame, wanted: DataFrame) -> DataFrame:
    """The stored summary of every wanted four-column key; null values where there is none."""
    return join_on(wanted.select(*SUMMARY_KEY), summary, SUMMARY_KEY)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name and row count."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def reset_audit(tables: Mapping[str, DataFrame], tick: DataFrame) -> DataFrame:
    """All row counts and the current tick in one row, and whether everything is empty."""
    counts = row_counts(tables)
    columns = [
        F.max(F.when(F.col("table_name") == name, F.col("row_count"))).alias(f"{name}_count")
        for name in tables
    ]
    now = F.coalesce(tick.agg(F.max(TICK)).scalar(), F.lit(0))
    return counts.agg(
        *columns,
        F.first(now).cast("long").alias("current_tick"),
        (F.bool_and(F.col("row_count") == 0) & (F.first(now) == 0)).alias("all_cleared"),
    )


def orphans(child: DataFrame, parent: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Child rows whose reference has no parent; null references are no orphans."""
    present = child
    for c in columns:
        present = present.where(F.col(c).isNotNull())
    return present.join(parent.select(*columns).distinct(), list(columns), "left_anti")


def foreign_key_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The number of orphans per foreign key of the dimension tables."""
    found = None
    for child, columns, parent in FOREIGN_KEYS:
        one = orphans(tables[child], tables[parent], columns).agg(F.count("*").alias("orphan_count")).select(
            F.lit(child).alias("table_name"),
            F.lit(parent).alias("parent_name"),
            F.lit(",".join(columns)).alias("key_columns"),
            "orphan_count",
        )
        found = one if found is None else found.unionByName(one)
    return found


def grown(old: DataFrame, new: DataFrame) -> DataFrame:
    """Both tables' rows under the union of their columns; missing ones are null."""
    return old.unionByName(new, allowMissingColumns=True)


def invalidated(
    history: DataFrame, summary: DataFrame, changed: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """History and summaries after some queries' configs change.

    ``changed`` has ``query_id`` and ``source``: the queries lose their history, and their
    streams lose all summaries.
    """
    streams = changed.select(F.col("source").alias("stream_name")).distinct()
    return (
        history.join(changed.select("query_id").distinct(), "query_id", "left_anti"),
        summary.join(streams, "stream_name", "left_anti"),
    )


def payload_copies(files: DataFrame) -> DataFrame:
    """Among binary files, the first by time and path of each distinct content."""
    hashed = files.withColumn("digest", F.md5("content")).drop("content")
    return first_wins(hashed, ["digest"], ["modificationTime", "path"])
