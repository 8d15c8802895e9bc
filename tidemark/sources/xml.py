"""XML record files: typed reading, validation, whole-file rejection, first-wins keys."""

from __future__ import annotations

from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.operators.tables import first_wins
from tidemark.session import settled
from tidemark.sources.schemas import Stream

CORRUPT = "_corrupt"
FAULT = "_fault"
XSD_FOLDER = Path(__file__).parent / "xsd"
#: Records of a written file.  One task reads a record file from end to end, so files must not grow with the stream.
RECORDS_PER_FILE = 100_000


def _options(spark: SparkSession, stream: Stream) -> dict[str, str]:
    xsd = XSD_FOLDER / f"{stream.row_tag}.xsd"
    _ship(spark.sparkContext.applicationId, spark, str(xsd))
    return {
        "rowTag": stream.row_tag,
        "rowValidationXSDPath": xsd.name,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
    }


@cache
def _ship(application: str, spark: SparkSession, xsd: str) -> None:
    """Send the record schema to every executor, once per application."""
    spark.sparkContext.addFile(xsd)


def _schema(stream: Stream) -> StructType:
    return StructType([*stream.schema.fields, StructField(CORRUPT, StringType())])


def _with_file(rows: DataFrame, stream: Stream) -> DataFrame:
    key = F.col(stream.key)
    fault = F.when(F.col(CORRUPT).isNotNull(), "invalid record").when(
        key.isNull() | (F.trim(key) == ""), "no key"
    )
    return rows.select(
        "*",
        fault.alias(FAULT),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("file_time"),
    )


def read_records(spark: SparkSession, stream: Stream, path: str) -> DataFrame:
    """All records under ``path``; one that fails its schema keeps its text in ``_corrupt``.

    ``_fault`` tells why a record is refused: an invalid record, or a missing key.
    """
    reader = spark.read.format("xml").schema(_schema(stream)).options(**_options(spark, stream))
    return _with_file(reader.load(path), stream)


def stream_records(
    spark: SparkSession, stream: Stream, path: str, max_files: int | None = None
) -> DataFrame:
    """The same as a stream over the files that arrive under ``path``."""
    reader = spark.readStream.format("xml").schema(_schema(stream)).options(**_options(spark, stream))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _with_file(reader.load(path), stream)


def file_states(records: DataFrame, stream: Stream) -> DataFrame:
    """file_path, file_time, number of faults and digest of every file with records.

    The digest is made of the number of records and two sums of their hashes: it follows from the content, adds up in
    the tasks that read parts of a file, and needs no second reading.  Bad records count with their text.
    """
    content = [*stream.schema.fieldNames(), CORRUPT]
    sums = [F.sum(h.cast("decimal(20,0)")).cast("string") for h in (F.xxhash64(*content), F.xxhash64(F.lit(1), *content))]
    return records.groupBy("file_path", "file_time").agg(
        F.count(FAULT).alias("faults"), F.concat_ws(" ", F.count("*").cast("string"), *sums).alias("digest")
    )


def fresh_files(states: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The first file, by time and path, of each content that is not among the digests ``known``."""
    fresh = first_wins(states, ["digest"], ["file_time", "file_path"])
    return fresh if known is None else fresh.join(known.select("digest"), "digest", "left_anti")


def split_files(records: DataFrame, states: DataFrame, fresh: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) records: one bad record rejects its whole file, a file that is not fresh is passed over.

    Files are told apart by joins with the smaller kinds of them, those that are bad or copies.
    """
    copies = states.join(fresh, "file_path", "left_anti").select("file_path")
    bad = fresh.where(F.col("faults") > 0).select("file_path")
    accepted = records.join(bad.unionByName(copies), "file_path", "left_anti").drop(CORRUPT, FAULT)
    return accepted, records.join(bad, "file_path", "left_semi")


def arrived_first(records: DataFrame, stream: Stream) -> DataFrame:
    """The first record of each key: by file time, then path, then all columns."""
    others = [c for c in stream.schema.fieldNames() if c != stream.key]
    return first_wins(records, [stream.key], ["file_time", "file_path", *others])


def _split(spark: SparkSession, stream: Stream, path: str) -> tuple[DataFrame, DataFrame]:
    records = settled(read_records(spark, stream, path), "records")
    states = settled(file_states(records, stream), "files")
    return split_files(records, states, fresh_files(states))


def ingest(spark: SparkSession, stream: Stream, path: str) -> DataFrame:
    """The stream rows that a folder of record files holds; of files of one content only the first is taken."""
    return arrived_first(_split(spark, stream, path)[0], stream).select(*stream.schema.fieldNames())


def quarantine(spark: SparkSession, stream: Stream, path: str) -> DataFrame:
    """The records of rejected files, with the text of the bad ones; of files of one content only the first is kept."""
    return _split(spark, stream, path)[1]


def write_records(df: DataFrame, stream: Stream, path: str, by: str | None = None) -> None:
    """Write stream rows as record files of bounded size.

    ``by`` names a column that gets one folder per value, and a file per task and value: such a file is refused as a
    whole, and is never cut.
    """
    columns = stream.schema.fieldNames() + ([by] if by else [])
    writer = df.select(*columns).write.format("xml").options(rowTag=stream.row_tag, rootTag=stream.root_tag)
    writer = writer.partitionBy(by) if by else writer.option("maxRecordsPerFile", RECORDS_PER_FILE)
    writer.save(path)
