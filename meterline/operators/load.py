"""Trip files to the loaded table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.schemas import CSV_TIMES
from meterline.sources.files import read_csv


def load_trips(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The trip files at ``path`` under their own column names, both times typed.

    Without a schema Spark reads the files once more to infer the types. With
    one (``schemas.CSV_TRIP``) there is no extra pass, and a value that does not
    fit fails the load rather than turning into NULL.
    """
    return with_times(read_csv(spark, path, schema))


def with_times(frame: DataFrame) -> DataFrame:
    """Both time columns as zone-less timestamps, from text or any timestamp type."""
    return frame.withColumns({name: F.col(name).cast("timestamp_ntz") for name in CSV_TIMES})


def describe_ddl(frame: DataFrame) -> str:
    """The columns and types as DDL."""
    return frame.schema.toDDL()
