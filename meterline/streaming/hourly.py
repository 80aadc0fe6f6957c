"""The hourly aggregate as a stream of updated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from meterline.operators.hourly import hourly_fares
from meterline.streaming.clock import (
    DISORDER_SECONDS,
    EVENT_TIME,
    LATENESS_SECONDS,
    timed_trips,
)

# After partial aggregation a micro-batch sends few rows per hour of day and open
# window: a few state partitions are plenty, and each of them costs a commit per
# batch. The checkpoint keeps the number it was started with.
STATE_PARTITIONS = 8


def hourly_updates(lines: DataFrame, event_time: str = "timestamp") -> DataFrame:
    """Running hourly rows in update mode; the last row per group is the result.

    A row is dropped once its window ended more than the disorder plus the
    allowed lateness before the newest row. State is a sum and a count per
    group. For the rows as they would be fired, see ``lateness``.
    """
    delay = DISORDER_SECONDS + LATENESS_SECONDS
    return hourly_fares(timed_trips(lines, event_time, delay), EVENT_TIME)


def checkpointed(
    writer: DataStreamWriter, name: str, checkpoint: str, interval: str | None = "60 seconds"
) -> DataStreamWriter:
    """Name, checkpoint folder and trigger; no interval means: take what is there and stop."""
    writer = writer.queryName(name).option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)
