"""File sources: trip CSVs, line files and message tables, bounded or streamed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.schemas import MESSAGE


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV files with a header line; types inferred unless a schema is given."""
    reader = spark.read.option("header", True)
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema).option("mode", "FAILFAST")
    return reader.csv(path)


def line_file(spark: SparkSession, path: str) -> DataFrame:
    """Text files, one message per line, header lines included; CR LF is one line end."""
    lines = spark.read.text(path)
    return lines.select("value", F.col("_metadata.file_modification_time").alias("timestamp"))


def line_file_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """The same as a stream. A text file has no record time; its age stands in for it."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.load(path)
    return lines.select("value", F.col("_metadata.file_modification_time").alias("timestamp"))


def message_table(spark: SparkSession, path: str) -> DataFrame:
    """Messages kept as Parquet: ``value`` and the record time ``timestamp``."""
    return spark.read.schema(MESSAGE).parquet(path)


def message_stream(
    spark: SparkSession,
    path: str,
    files_per_batch: int | None = None,
    bytes_per_batch: str | None = None,
) -> DataFrame:
    """The same as a stream.

    Files are taken in order of age. Set a limit per batch only when their age
    follows their record times, or the watermark drops the older ones.
    """
    return table_stream(spark, path, MESSAGE, files_per_batch, bytes_per_batch)


def table_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files_per_batch: int | None = None,
    bytes_per_batch: str | None = None,
) -> DataFrame:
    """A Parquet table as a stream of its files, so many or so much of them in a batch."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.parquet(path)
