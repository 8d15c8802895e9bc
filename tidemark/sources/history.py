"""The result history: typed rows, their JSON form, and the files that hold both."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, LongType, NumericType, StringType, StructField, StructType

from tidemark.config import TICK
from tidemark.functions.values import object_list, whole_number_text
from tidemark.sources.schemas import HISTORY, SUMMARY, SUMMARY_KEY

def _number_text(field: StructField) -> Column:
    """A number as JSON text: whole numbers without a fraction, integers and decimals from their own digits."""
    value = F.col(field.name)
    if isinstance(field.dataType, IntegralType):
        return value.cast("string")
    if isinstance(field.dataType, DecimalType):
        text = value.cast("string")
        plain = F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
        return F.when(text.contains("."), plain).otherwise(text)
    return whole_number_text(value.cast("double"))


def _member(field: StructField) -> Column:
    if isinstance(field.dataType, NumericType):
        return F.concat(F.lit(f'"{field.name}":'), F.coalesce(_number_text(field), F.lit("null")))
    # a one-field object without its braces
    whole = F.to_json(F.struct(F.col(field.name).cast("string").alias(field.name)), {"ignoreNullFields": "false"})
    return F.substr(whole, F.lit(2), F.length(whole) - 2)


def json_history(rows: DataFrame, query_id: str, keys: list[str]) -> DataFrame:
    """History rows as JSON: per tick one array of the result objects, in key order.

    This is a view for readers of the JSON form; a tick's text holds all its groups.  Results with
    more groups than fit a text are kept as typed rows (:func:`append_results`).
    """
    fields = [f for f in rows.schema.fields if f.name != TICK]
    text = F.concat(F.lit("{"), F.concat_ws(",", *map(_member, fields)), F.lit("}"))
    order = F.array(*(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys)) if keys else F.array(F.lit(""))
    own = F.pmod(F.xxhash64(F.lit(query_id)), F.lit(1 << 20))
    return (
        rows.select(TICK, order.alias("k"), text.alias("o"))
        .groupBy(TICK)
        .agg(F.sort_array(F.collect_list(F.struct("k", "o"))).alias("items"))
        .select(
            (F.col(TICK).cast("long") * F.lit(1 << 20) + own).alias("id"),
            F.lit(query_id).alias("query_id"),
            F.col(TICK).cast("long").alias(TICK),
            F.concat(F.lit("["), F.array_join(F.col("items.o"), ","), F.lit("]")).alias("result"),
        )
    )


#: Ticks of a folder of stored results.
TICKS_PER_FOLDER = 1024
COMMIT = "query_id string, b long, written long, attempt string, first long, last long, columns string"


def append_results(rows: DataFrame, path: str, query_id: str, batch: int = 0) -> None:
    """Store a query's results of one batch as typed rows; a repeated batch replaces its own, also by no rows.

    Rows go to a folder of their own, by ranges of ticks.  A commit, written last, names the folder and its first
    and last tick; readers follow the newest commit of every batch, so what an interrupted or replaced attempt left
    behind is never read.
    """
    spark = rows.sparkSession
    attempt, seen = f"a-{uuid.uuid4().hex}", Observation()
    bucket = F.floor(F.col(TICK) / F.lit(TICKS_PER_FOLDER)).alias("tick_bucket")
    ends = [F.min(TICK).cast("long").alias("first"), F.max(TICK).cast("long").alias("last")]
    rows.select("*", bucket).observe(seen, *ends).write.partitionBy("tick_bucket").parquet(
        f"{path}/rows/query_id={query_id}/attempt={attempt}"
    )
    found = seen.get
    commit = (query_id, batch, time.time_ns(), attempt, found["first"], found["last"], rows.schema.json())
    spark.createDataFrame([commit], COMMIT).coalesce(1).write.mode("append").parquet(f"{path}/commits")


def _commits(spark: SparkSession, path: str) -> DataFrame:
    """The newest commit of every query and batch."""
    stored = spark.read.schema(COMMIT).parquet(f"{path}/commits")
    others = [f.name for f in stored.schema if f.name not in ("query_id", "b")]
    newest = F.max_by(F.struct(*others), "written").alias("commit")
    return stored.groupBy("query_id", "b").agg(newest).select("query_id", "commit.*")


def _committed(spark: SparkSession, path: str, query_id: str, commits: DataFrame) -> DataFrame:
    columns = StructType.fromJson(json.loads(commits.orderBy(F.desc("written")).first()["columns"]))
    folders = [StructField("attempt", StringType()), StructField("tick_bucket", LongType())]
    stored = spark.read.schema(StructType([*columns.fields, *folders])).parquet(f"{path}/rows/query_id={query_id}")
    return stored.join(commits.select("attempt"), "attempt", "left_semi").drop("attempt")


def read_results(spark: SparkSession, path: str, query_id: str, last_ticks: int | None = None) -> DataFrame:
    """A query's typed results, or those of its last ticks, for which only the folders that hold them are read.

    A batch stored several times counts as its last attempt; a query never stored is an error.
    """
    commits = _commits(spark, path).where(F.col("query_id") == query_id)
    rows = _committed(spark, path, query_id, commits)
    if last_ticks is not None:
        newest = commits.agg(F.max("last")).first()[0]
        oldest = (newest or 0) - last_ticks
        rows = rows.where((F.col("tick_bucket") >= oldest // TICKS_PER_FOLDER) & (F.col(TICK) >= oldest))
    return rows.drop("tick_bucket")


def newest_result(spark: SparkSession, path: str, query_id: str) -> DataFrame:
    """A query's typed results at its newest tick, which the commits tell."""
    return read_results(spark, path, query_id, 0)


def append_history(history: DataFrame, path: str, query_id: str, batch: int = 0) -> None:
    """Store a query's JSON history rows of one batch as :func:`append_results` does; empty results are left out."""
    append_results(history.where(F.length("result") > 2).drop("query_id"), path, query_id, batch)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The stored JSON history of all queries."""
    fields = [f for f in HISTORY.fields if f.name != "query_id"]
    folders = [StructField(c, StringType()) for c in ("query_id", "attempt")]
    stored = spark.read.schema(StructType([*fields, *folders])).parquet(f"{path}/rows")
    commits = _commits(spark, path).select("query_id", "attempt")
    return stored.join(commits, ["query_id", "attempt"], "left_semi").select(*HISTORY.fieldNames())


def parsed_history(history: DataFrame) -> DataFrame:
    """All results in storage order, parsed; bad JSON is an empty list."""
    return history.select("id", "query_id", TICK, object_list(F.col("result")).alias("result")).orderBy(TICK, "id")


#: So many runs of one level of a summary are merged into one of the next level.
RUNS_PER_LEVEL = 8
#: Lists of runs that a summary keeps; the oldest makes room for the next one.
RUN_LISTS = 4
_LIST = "version long, runs array<struct<folder: string, level: int>>, slot int"
_RUN = StructType([*SUMMARY.fields, StructField("v", LongType())])


def write_summary(changed: DataFrame, path: str, version: int) -> None:
    """Write the summary rows that a batch changed as a run of their own, and merge runs that have become many.

    ``RUNS_PER_LEVEL`` runs of one level become one of the next, so a summary of n versions has at most
    ``RUNS_PER_LEVEL - 1`` runs for each of its log n levels, and a row is written again once per level.  Versions
    ascend.  The list of runs is written last; the newest version may be written again and then replaces itself, since
    it goes on from the list of the version before.  Runs that no list names any more are left behind.
    """
    spark = changed.sparkSession
    lists = _run_lists(spark, path)
    if lists and lists[0]["version"] > version:
        raise ValueError(f"version {version} comes after version {lists[0]['version']}, which is stored already")
    before = next((entry["runs"] for entry in lists if entry["version"] < version), [])
    runs = [(r["folder"], r["level"]) for r in before]
    runs.append((_write_run(changed.withColumn("v", F.lit(version).cast("long")), path), 0))
    merged, level = _runs_to_merge([level for _, level in runs])
    if merged:
        newest = _newest_rows(_read_runs(spark, path, [folder for folder, _ in runs[-merged:]]))
        runs[-merged:] = [(_write_run(newest, path), level)]
    again = [entry["slot"] for entry in lists if entry["version"] == version]
    free = sorted(set(range(RUN_LISTS)) - {entry["slot"] for entry in lists})
    slot = (again or free or [lists[-1]["slot"]])[0]
    entry = spark.createDataFrame([(version, runs, slot)], _LIST).drop("slot")
    entry.coalesce(1).write.mode("overwrite").parquet(f"{path}/lists/slot={slot}")


def _run_lists(spark: SparkSession, path: str) -> list[Row]:
    """The kept lists of runs, the newest first; none, if the summary was never written."""
    try:
        # a list that a writer replaces meanwhile is an old one
        return spark.read.schema(_LIST).option("ignoreMissingFiles", True).parquet(f"{path}/lists").orderBy(F.desc("version")).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def _runs_to_merge(levels: list[int]) -> tuple[int, int]:
    """How many of the last runs are due for merging, and the level of the run they become."""
    merged, level = 0, 0
    while levels.count(level) + (merged > 0) >= RUNS_PER_LEVEL:
        merged, level = merged + levels.count(level), level + 1
    return merged, level


def _write_run(rows: DataFrame, path: str) -> str:
    folder = f"r-{uuid.uuid4().hex}"
    rows.select(*_RUN.fieldNames()).write.parquet(f"{path}/runs/{folder}")
    return folder


def _read_runs(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    return spark.read.schema(_RUN).parquet(*(f"{path}/runs/{folder}" for folder in folders))


def _newest_rows(rows: DataFrame) -> DataFrame:
    """The newest row of every summary key; at the same tick the later version wins."""
    kept = [c for c in _RUN.fieldNames() if c not in SUMMARY_KEY]
    newest = F.max_by(F.struct(*kept), F.struct("last_updated_tick", "v")).alias("__row")
    return rows.groupBy(*SUMMARY_KEY).agg(newest).select(*SUMMARY_KEY, "__row.*")


def summary_runs(spark: SparkSession, path: str) -> list[str]:
    """The folders that hold a summary now; a summary never written is an error."""
    lists = _run_lists(spark, path)
    if not lists:
        raise ValueError(f"no summary was written to {path}")
    return [r["folder"] for r in lists[0]["runs"]]


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of every summary key over all versions; at the same tick the later version wins."""
    rows = _newest_rows(_read_runs(spark, path, summary_runs(spark, path)))
    return rows.select(*SUMMARY.fieldNames())


def compact_summary(spark: SparkSession, path: str, target: str) -> None:
    """Write all versions as one, in a new folder to go on from, which then holds nothing that was left behind."""
    write_summary(read_summary(spark, path), target, 0)


def write_stream_table(df: DataFrame, path: str, ticks_per_folder: int = 1024) -> None:
    """Store stream rows in folders of consecutive ticks, and beside them which ticks were written."""
    seen = Observation()
    bucket = F.floor(F.col(TICK) / F.lit(ticks_per_folder)).alias("tick_bucket")
    newest = F.max(TICK).cast("long").alias("last")
    df.select("*", bucket).observe(seen, newest).write.mode("append").partitionBy("tick_bucket").parquet(f"{path}/rows")
    zone = df.sparkSession.createDataFrame([(seen.get["last"], df.schema.json())], "last long, columns string")
    zone.coalesce(1).write.mode("append").parquet(f"{path}/zones")


def read_stream_table(
    spark: SparkSession, path: str, last_ticks: int | None = None, ticks_per_folder: int = 1024
) -> DataFrame:
    """A stored stream, or only what a time window of ``last_ticks`` still holds.

    The newest tick and the columns come from the small table beside the rows, so that no file of an old folder
    is opened.
    """
    zones = spark.read.schema("last long, columns string").parquet(f"{path}/zones")
    known = zones.agg(F.max("last").alias("last"), F.max_by("columns", F.coalesce("last", F.lit(-(1 << 62)))).alias("columns")).first()
    columns = StructType.fromJson(json.loads(known["columns"]))
    stored = spark.read.schema(StructType([*columns.fields, StructField("tick_bucket", LongType())])).parquet(f"{path}/rows")
    if last_ticks is not None and known["last"] is not None:
        oldest = known["last"] - last_ticks
        stored = stored.where((F.col("tick_bucket") >= oldest // ticks_per_folder) & (F.col(TICK) >= oldest))
    return stored.drop("tick_bucket")
