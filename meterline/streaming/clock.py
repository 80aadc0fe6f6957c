"""Event time and watermarks of the hourly stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.operators.parse import parse_trips
from meterline.session import require_utc

# Fixed values, in seconds: window, out-of-orderness, allowed lateness.
WINDOW_SECONDS = 3600
DISORDER_SECONDS = 10
LATENESS_SECONDS = 300

EVENT_TIME = "event_time"


def with_event_time(frame: DataFrame, column: str, delay_seconds: int) -> DataFrame:
    """``frame`` with the watermarked column ``event_time``.

    Watermarks need a TIMESTAMP, so a zone-less trip time is read as UTC. The
    watermark follows the newest row of all partitions; an idle one never holds
    it back. With a topic of several uneven partitions use a longer delay.
    """
    require_utc(frame.sparkSession)
    timed = frame.withColumn(EVENT_TIME, F.col(column).cast("timestamp"))
    return timed.withWatermark(EVENT_TIME, f"{delay_seconds} seconds")


def timed_trips(
    lines: DataFrame, event_time: str = "timestamp", delay_seconds: int = DISORDER_SECONDS
) -> DataFrame:
    """Trips with ``event_time``: the record time of the line or a time of the trip.

    The record time is watermarked before parsing, so that a rejected line
    moves the clock like any other message.
    """
    if event_time in lines.columns:
        return parse_trips(with_event_time(lines, event_time, delay_seconds))
    return with_event_time(parse_trips(lines), event_time, delay_seconds)
