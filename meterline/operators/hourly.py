"""Mean fare and trip count per pickup hour and one-hour window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions.clock import hour_of_day
from meterline.functions.exact import exact_mean, exact_sums
from meterline.schemas import HOURLY
from meterline.session import require_utc

WINDOW = "1 hour"


def hourly_fares(trips: DataFrame, event_time: str = "timestamp", exact: bool = False) -> DataFrame:
    """One row per hour of day of the pickup and window of ``event_time``.

    Two clocks meet here. The window follows ``event_time``, by default the
    record time of the message; the hour always follows the pickup. Pass
    ``pickup_datetime`` to put both on the pickup.

    Partial aggregation keeps the shuffle at one row per group and task, so
    neither the few hours nor a crowded window makes a slow task. On a stream,
    set the watermark first (``meterline.streaming``).

    The last digits of a mean depend on the order in which tasks add up, unless it is
    ``exact``: then it has the same bits however the rows are dealt.
    """
    if isinstance(trips.schema[event_time].dataType, T.TimestampType):
        require_utc(trips.sparkSession)
    grouped = trips.groupBy(
        hour_of_day(F.col("pickup_datetime")).alias("hour"),
        F.window(event_time, WINDOW).alias("window"),
    ).agg(
        (exact_sums(F.col("fare_amount")) if exact else F.avg("fare_amount")).alias("average_fare"),
        F.count("*").alias("trip_count"),
    )
    mean = F.col("average_fare")
    return grouped.select(
        "hour",
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        (exact_mean(mean) if exact else mean).alias("average_fare"),
        "trip_count",
    )


def overall_fare(trips: DataFrame) -> DataFrame:
    """Mean fare and count of all trips; an empty input gives 0.0 and 0."""
    return trips.agg(
        F.coalesce(F.avg("fare_amount"), F.lit(0.0)).alias("average_fare"),
        F.count("*").alias("trip_count"),
    )


def latest(
    changes: DataFrame, order: tuple[str, ...] = ("written_at", "batch_id", "trip_count")
) -> DataFrame:
    """The last emitted row per (hour, window) of an append-only change log.

    The greatest row of each group in ``order`` is an aggregate, so the tasks shrink the
    log to a row per group before the shuffle. Batch numbers start anew with every run,
    hence the time of writing first, where the log has it.
    """
    order = tuple(name for name in order if name in changes.columns)
    rest = [c for c in HOURLY.fieldNames() if c not in ("hour", "window_start", *order)]
    newest: Column = F.max(F.struct(*order, *rest)).alias("newest")
    grouped = changes.groupBy("hour", "window_start").agg(newest)
    return grouped.select(
        "hour",
        "window_start",
        *(F.col(f"newest.{c}").alias(c) for c in ("window_end", "average_fare", "trip_count")),
    )
