"""The state of a stopped query of the hourly aggregate: shown as a table, and handed to another query.

A checkpoint keeps the number of state partitions it was started with. To go on with
another number, start a new query with a new checkpoint, ``moved_state`` of the old one,
and the input that the old one has not taken in. The windows still open come
as the initial state of the new query, dealt by key over its own partitions, with their
timers; the old watermark is the least the new query goes by, so that rows which were too late
stay so. Both queries must be of the same lateness and disorder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.session import ROCKSDB, stream_settings
from meterline.streaming.clock import WINDOW_SECONDS

TOTALS = "totals"


@dataclass(frozen=True)
class MovedState:
    """Windows as (hour, window_ms, fare_sum, trip_count, fired), and the watermark they were left at."""

    windows: DataFrame
    watermark_ms: int


def watermark_of(spark: SparkSession, checkpoint: str) -> int:
    """The last watermark, in epoch milliseconds, of the query that wrote the checkpoint."""
    notes = spark.read.text(f"{checkpoint.rstrip('/')}/offsets")
    marks = notes.select(F.get_json_object("value", "$.batchWatermarkMs").cast("long").alias("mark"))
    return marks.agg(F.max("mark")).first()[0] or 0


def held_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state of the windows that are not cleared yet."""
    with stream_settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB):
        state = (
            spark.read.format("statestore").option("path", checkpoint).option("stateVarName", TOTALS).load()
        )
        return state.select("key.hour", "key.window_ms", "value.fare_sum", "value.trip_count", "value.fired")


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows a stopped query holds: what they would emit now, and whether they have fired."""
    start = F.timestamp_millis("window_ms")
    end = F.timestamp_millis(F.col("window_ms") + WINDOW_SECONDS * 1000)
    return held_windows(spark, checkpoint).select(
        "hour",
        start.cast("timestamp_ntz").alias("window_start"),
        end.cast("timestamp_ntz").alias("window_end"),
        (F.col("fare_sum") / F.col("trip_count")).alias("average_fare"),
        "trip_count",
        "fired",
    )


def moved_state(spark: SparkSession, checkpoint: str) -> MovedState:
    """What a new query needs to go on for the one that wrote the checkpoint and has stopped."""
    return MovedState(held_windows(spark, checkpoint), watermark_of(spark, checkpoint))
