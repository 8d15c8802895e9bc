"""Stream-shaped views over the analytics tables in a parquet folder.

Measures become DECIMAL(18,3), which holds them exactly: sums then do not depend on the order in
which tasks finish or are retried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EXACT = "decimal(18,3)"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _days(column: str, origin: str):
    return F.datediff(F.col(column).cast("date"), F.lit(origin).cast("date"))


def _hour() -> Column:
    """Hours since 2024-01-01."""
    return (_days("ts", "2024-01-01") * 24 + F.hour("ts")).cast("int")


def _minute() -> Column:
    return (_hour() * 60 + F.minute("ts")).cast("int")


def _padded(prefix: str):
    digits = F.col("event_id").cast("string")
    wide = F.when(F.length(digits) < 6, F.lpad(digits, 6, "0")).otherwise(digits)
    return F.concat(F.lit(prefix), wide)


def _crossing():
    return F.concat(F.lit("I"), (F.col("user_id") % 3 + 101).cast("string"))


def _road():
    return F.concat(_crossing(), F.lit("_R"), (F.col("user_id") % 4 + 1).cast("string"))


def sensor_rows(events: DataFrame, minutes: bool = False) -> DataFrame:
    """One sensor packet per row of ``events``; ticks are hours, or minutes on request."""
    return events.select(
        _padded("PKT_").alias("pkt_id"),
        _crossing().alias("intersection_id"),
        _road().alias("road_id"),
        F.concat(_road(), F.lit("_TL")).alias("signal_id"),
        F.get_json_object("props", "$.k").cast("int").alias("vehicle_count"),
        F.col("value").cast(EXACT).alias("avg_speed"),
        (F.col("value").cast(EXACT) * F.lit("0.2").cast("decimal(2,1)")).cast(EXACT).alias("occupancy"),
        (_minute() if minutes else _hour()).alias("ts"),
    )


def event_rows(events: DataFrame) -> DataFrame:
    return events.select(
        _padded("EVT_").alias("event_id"),
        "event_type",
        _crossing().alias("intersection_id"),
        _road().alias("road_id"),
        (F.col("event_id") % 3 + 1).cast("int").alias("priority"),
        _hour().alias("ts"),
    )


def command_rows(orders: DataFrame) -> DataFrame:
    """One command per row of ``orders``; ticks are days since 1995-01-01."""
    return orders.select(
        F.col("o_orderkey").cast("string").alias("cmd_id"),
        F.concat(F.lit("S"), (F.col("o_custkey") % 10).cast("string")).alias("signal_id"),
        F.col("o_orderstatus").alias("action"),
        F.floor("o_totalprice").cast("int").alias("duration"),
        F.col("o_orderpriority").alias("reason"),
        _days("o_orderdate", "1995-01-01").alias("ts"),
    )


def shipment_rows(lineitem: DataFrame) -> DataFrame:
    """The scale stream: one row per ``lineitem`` row; ticks are days since 1995-01-01."""
    return lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
        F.col("l_quantity").cast(EXACT).alias("l_quantity"),
        F.col("l_extendedprice").cast(EXACT).alias("l_extendedprice"),
        _days("l_shipdate", "1995-01-01").alias("ts"),
    )


def sensor_stream(spark: SparkSession, folder: str, minutes: bool = False) -> DataFrame:
    return sensor_rows(table(spark, folder, "events"), minutes)


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    return event_rows(table(spark, folder, "events"))


def command_stream(spark: SparkSession, folder: str) -> DataFrame:
    return command_rows(table(spark, folder, "orders"))


def shipments(spark: SparkSession, folder: str) -> DataFrame:
    return shipment_rows(table(spark, folder, "lineitem"))


def arriving(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table's files as a stream."""
    schema = table(spark, folder, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def dimensions(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four dimension tables, as the sensor stream names them.

    Only roads with at least the average number of packets are listed, so that the foreign keys
    have something to miss.
    """
    rows = sensor_stream(spark, folder)
    roads = rows.groupBy("road_id", "intersection_id").agg(F.count("*").alias("n"))
    typical = rows.agg(F.count("*") / F.count_distinct("road_id")).scalar()
    crossing = rows.groupBy("intersection_id").agg(F.count_distinct("road_id").cast("int").alias("num_roads"))
    signals = rows.select("signal_id", "intersection_id", "road_id").distinct()
    return {
        "intersection": crossing.select("intersection_id", F.lit(None).cast("string").alias("location"), "num_roads"),
        "road": roads.where(F.col("n") >= typical).select(
            "road_id", "intersection_id", F.lit("N").alias("direction"), F.lit(1).alias("num_lanes")
        ),
        "traffic_signal": signals.withColumns(
            {"current_state": F.lit("RED"), "last_updated": F.lit(None).cast("timestamp")}
        ),
        "signal_group": signals.select(F.lit(1).alias("group_id"), "signal_id"),
    }
