"""Live form: record files in, per-tick parts out, histories read from the parts.

Two stages per source.  The first validates and rejects whole files, so a rejected file never
claims a key.  The second drops keys seen in earlier batches and stores mergeable parts per tick.
A late row only adds to the parts of its own tick, so the history read from the parts equals the
batch result, however files were grouped into batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.config import TICK, QueryConfig, WindowSpec
from tidemark.functions.aggregates import merge_column, parts_of
from tidemark.operators.clock import ticks_of
from tidemark.operators.evaluate import newest_of_ticks, rows_per_tick
from tidemark.plans.run import (
    history_from_newest,
    history_from_parts,
    metrics_from_parts,
    metrics_to_store,
    parts_to_store,
    with_companions,
)
from tidemark.session import settled
from tidemark.sources.schemas import Stream
from tidemark.sources.xml import arrived_first, file_states, fresh_files, split_files, stream_records

# the folder column of a stage's batches
ARRIVAL = "b"


def _after_epoch():
    """The tick as a time later than the epoch, where watermarks start, for any 32-bit tick."""
    return F.timestamp_seconds(F.col(TICK).cast("long") + F.lit((1 << 31) + 1))


def start_cleaning(
    spark: SparkSession, stream: Stream, inbox: str, out: str, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """Stage 1: accepted records to ``out/clean``, rejected files' records to ``out/quarantine``.

    A file whose content an earlier one had, in this batch or before, is passed over: it adds no row and moves no
    clock.  ``out/payloads`` remembers a digest per file.  Each batch owns one folder in each of the three, so a batch
    that is run again after a failure replaces its output, and only batches before it count as earlier.
    """
    kinds = "file_path string, digest string, b long"

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            states = settled(file_states(batch, stream), "files")
            earlier = None
            if batch_id:
                earlier = spark.read.schema(kinds).parquet(f"{out}/payloads").where(F.col("b") < batch_id)
            fresh = settled(fresh_files(states, earlier), "fresh")
            fresh.select("file_path", "digest").write.mode("overwrite").parquet(f"{out}/payloads/b={batch_id}")
            accepted, rejected = split_files(batch, states, fresh)
            rejected.write.mode("overwrite").parquet(f"{out}/quarantine/b={batch_id}")
            arrived_first(accepted, stream).select(*stream.schema.fieldNames()).write.mode(
                "overwrite"
            ).parquet(f"{out}/clean/b={batch_id}")
        finally:
            batch.unpersist()

    records = stream_records(spark, stream, inbox, max_files)
    return _start(records, store, checkpoint)


def first_seen(rows: DataFrame, key: str, arrival: Sequence[str]) -> DataFrame:
    """The first row of each key of a stream, for output mode ``update``.

    ``current_timestamp`` is one value per micro-batch and is kept across retries.  A key all of
    whose rows carry the same value is new in this batch; its first row along ``arrival`` wins.
    """
    # the least row itself is kept, as ordering and row in one
    rest = [*arrival, *(c for c in rows.columns if c not in (key, *arrival))]
    return (
        rows.withColumn("__seen", F.current_timestamp())
        .groupBy(F.col(key).alias("__key"))
        .agg(
            F.min(F.struct(*rest)).alias("__row"),
            F.min("__seen").alias("__since"),
            F.max("__seen").alias("__now"),
        )
        .where(F.col("__since") == F.col("__now"))
        .select(*(F.col("__key").alias(c) if c == key else F.col("__row")[c].alias(c) for c in rows.columns))
    )


def start_parts(
    spark: SparkSession,
    rows: DataFrame,
    key: str,
    configs: Sequence[QueryConfig],
    out: str,
    checkpoint: str,
    horizon: str | None = None,
    keep_rows: bool = False,
    companions: dict[str, Sequence[QueryConfig]] | None = None,
    metrics: Sequence[QueryConfig] = (),
    row_windows: dict[str, WindowSpec] | None = None,
) -> StreamingQuery:
    """Stage 2: drop repeated keys, then store each query's per-tick parts and the rows per tick of the batch.

    ``metrics`` are configs whose long metrics are stored too.  ``companions`` lists, by query id, the queries whose
    summary targets a query's derived metrics use.  ``row_windows`` lists, by query id, the row-count window of a
    query that has one: of that query, the newest rows of every tick are stored in place of parts.

    Without ``horizon`` every key is remembered and the earliest arrival wins.  With one, state is
    bounded: keys are remembered that long in event time, rows older than that are dropped (see
    :func:`dropped_late`), and which of two copies within one batch wins is left open.
    """
    if horizon:
        unique = (
            rows.withColumn("__et", _after_epoch())
            .withWatermark("__et", horizon)
            .dropDuplicatesWithinWatermark([key])
            .drop("__et")
        )
    else:
        order = [ARRIVAL] if ARRIVAL in rows.columns else []
        unique = first_seen(rows, key, order + [c for c in rows.columns if c not in (key, ARRIVAL)])
    unique = unique.drop(ARRIVAL)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for config in configs:
                own = (companions or {}).get(config.query_id, ())
                window = (row_windows or {}).get(config.query_id)
                if window is not None:
                    wide = with_companions(config, own, batch.schema)
                    newest_of_ticks(batch, wide, window.size, key).write.mode("overwrite").parquet(
                        f"{out}/newest/{config.query_id}/b={batch_id}"
                    )
                    continue
                parts_to_store(batch, config, own).write.mode("overwrite").parquet(
                    f"{out}/parts/{config.query_id}/b={batch_id}"
                )
            for config in metrics:
                metrics_to_store(batch, config).write.mode("overwrite").parquet(
                    f"{out}/metrics/{config.query_id}/b={batch_id}"
                )
            rows_per_tick(batch).write.mode("overwrite").parquet(f"{out}/ticks/b={batch_id}")
            if keep_rows:
                batch.write.mode("overwrite").parquet(f"{out}/rows/b={batch_id}")
        finally:
            batch.unpersist()

    query = _start(unique, store, checkpoint, "append" if horizon else "update")
    if horizon:
        spark.streams.addListener(_LateRows(spark, str(query.id), f"{out}/late"))
    return query


def read_clean(spark: SparkSession, stream: Stream, out: str, max_files: int | None = None) -> DataFrame:
    """Stage 1's accepted rows as a stream; the batch that accepted a row tells when it arrived."""
    reader = spark.readStream.schema(StructType([*stream.schema.fields, StructField(ARRIVAL, LongType())]))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{out}/clean")


def read_parts(spark: SparkSession, out: str, config: QueryConfig) -> DataFrame:
    return spark.read.parquet(f"{out}/parts/{config.query_id}").drop("b")


def read_ticks(spark: SparkSession, *outs: str) -> DataFrame:
    """The clock of one or more streams: the ticks of all batches, also of those without matching rows."""
    return ticks_of(*(spark.read.schema(f"{TICK} long").parquet(f"{out}/ticks") for out in outs))


def read_counts(spark: SparkSession, out: str) -> DataFrame:
    """The rows per tick of all batches."""
    return spark.read.schema(f"{TICK} long, n long").parquet(f"{out}/ticks").groupBy(TICK).agg(F.sum("n").alias("n"))


def live_row_window(
    spark: SparkSession, out: str, config: QueryConfig, window: WindowSpec, key: str, mode: str = "history", **options
) -> DataFrame:
    """The history so far over a row-count window; options as in :func:`history_from_newest`.

    The window must be the one its rows were stored with, or a smaller one.
    """
    rows = spark.read.parquet(f"{out}/newest/{config.query_id}").drop("b")
    return history_from_newest(rows, read_counts(spark, out), config, mode, window=window, key=key, **options)


def live_history(
    spark: SparkSession,
    out: str,
    config: QueryConfig,
    mode: str = "history",
    *,
    clock: DataFrame | None = None,
    **options,
) -> DataFrame:
    """The history so far, from all stored parts; options as in :func:`history_from_parts`.

    The clock is that of the stream itself unless another one is given.
    """
    clock = read_ticks(spark, out) if clock is None else clock
    return history_from_parts(read_parts(spark, out, config), config, mode, clock=clock, **options)


def live_metric_history(
    spark: SparkSession, out: str, config: QueryConfig, clock: DataFrame | None = None, **options
) -> DataFrame:
    """The long metrics so far, from the stored parts of all batches; options as in :func:`metrics_from_parts`."""
    parts = spark.read.parquet(f"{out}/metrics/{config.query_id}").drop("b")
    return metrics_from_parts(parts, config, read_ticks(spark, out) if clock is None else clock, **options)


def compact_newest(
    spark: SparkSession,
    out: str,
    config: QueryConfig,
    window: WindowSpec,
    key: str,
    target: str,
    companions: Sequence[QueryConfig] = (),
) -> None:
    """Merge the newest rows of all batches: what a tick keeps never exceeds the window."""
    read_counts(spark, out).write.mode("overwrite").parquet(f"{target}/ticks/b=0")
    rows = spark.read.parquet(f"{out}/newest/{config.query_id}").drop("b")
    newest_of_ticks(rows, with_companions(config, companions), window.size, key).write.mode("overwrite").parquet(
        f"{target}/newest/{config.query_id}/b=0"
    )


def compact_parts(
    spark: SparkSession, out: str, config: QueryConfig, target: str, companions: Sequence[QueryConfig] = ()
) -> None:
    """Merge the parts and ticks of all batches into one table each, with a row per tick and group."""
    read_counts(spark, out).write.mode("overwrite").parquet(f"{target}/ticks/b=0")
    parts = read_parts(spark, out, config)
    config = with_companions(config, companions)
    parts.groupBy(*config.group_by, TICK).agg(
        *(merge_column(p.within, p.name).alias(p.name) for p in parts_of(config))
    ).write.mode("overwrite").parquet(f"{target}/parts/{config.query_id}/b=0")


class _LateRows(StreamingQueryListener):
    """Stores, per batch of one query, how many rows were dropped for being older than its horizon."""

    def __init__(self, spark: SparkSession, query_id: str, path: str):
        self.spark, self.query_id, self.path = spark, query_id, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if str(progress.id) == self.query_id:
            late = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
            row = self.spark.range(1).select(F.lit(late).cast("long").alias("late"))
            row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/b={progress.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.query_id:
            self.spark.streams.removeListener(self)


def dropped_late(spark: SparkSession, out: str) -> int:
    """How many rows all batches so far dropped for being older than the horizon, restarts included.

    Counts arrive with the progress of a batch, shortly after the batch itself.
    """
    return spark.read.schema("late long").parquet(f"{out}/late").agg(F.sum("late")).first()[0] or 0


def _start(rows: DataFrame, store, checkpoint: str, mode: str = "append") -> StreamingQuery:
    return (
        rows.writeStream.outputMode(mode)
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
