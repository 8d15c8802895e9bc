"""Row positions in a total order, without sorting any tick in a single task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path


def positioned(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number rows from 1 along ``order``, which must be a total order.

    The rows are range-sorted into files in the shared folder; a row's position is its index
    within its file plus the rows of all earlier files.  A tick that holds a large share of the
    rows is simply spread over many files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "sorted")
    df.orderBy(*order).write.option("maxRecordsPerFile", 0).parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    file_no = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int")
    rows = stored.select("*", file_no.alias("__file"), F.col("_metadata.row_index").alias("__index"))
    counts = rows.groupBy("__file").agg(F.count("*").alias("__n"))
    earlier = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__file", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"))
    return rows.join(starts, "__file").withColumn(
        name, F.col("__start") + F.col("__index") + 1
    ).drop("__file", "__index", "__start")
