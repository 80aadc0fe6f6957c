"""Hourly windows that fire on time and fire again for each batch of late rows.

Spark's own windowed aggregate emits a window either once, after the lateness
is over, or after every batch from its first row on. Here a window emits

* ``ontime`` once the watermark reaches its end,
* ``refire`` with the updated totals whenever late rows still allowed arrive,
* ``drop`` with the number of rows that came after its state was cleared.

Rows are added up per task before any shuffle, and the tasks' totals once more by
window and salt. However crowded a window is and however many tasks there are, the
stateful operator sees at most ``combine`` small rows per window and batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from meterline.functions.clock import hour_of_day
from meterline.session import ship_by_value
from meterline.streaming.clock import (
    DISORDER_SECONDS,
    EVENT_TIME,
    LATENESS_SECONDS,
    WINDOW_SECONDS,
    timed_trips,
)
from meterline.streaming.moved import MovedState

ship_by_value(__name__)

PARTIAL_SCHEMA = "hour INT, window_ms BIGINT, fare_sum DOUBLE, trip_count BIGINT"
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("hour", T.IntegerType()),
        T.StructField("window_ms", T.LongType()),
        T.StructField("average_fare", T.DoubleType()),
        T.StructField("trip_count", T.LongType()),
        T.StructField("kind", T.StringType()),
    ]
)
STATE_SCHEMA = "fare_sum DOUBLE, trip_count BIGINT, fired BOOLEAN"
GROUP = ["hour", "window_ms"]
#: Totals of a window and batch that reach its state.
COMBINE = 16


def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals per window of one task; holds a row per window, not the input."""
    totals = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        if "trip_count" not in part.column_names:
            part = part.append_column("trip_count", pa.array([1] * part.num_rows, pa.int64()))
        part = part.rename_columns([*GROUP, "fare_sum", "trip_count"])
        totals = part if totals is None else pa.concat_tables([totals, part])
        sums = totals.group_by(GROUP).aggregate([("fare_sum", "sum"), ("trip_count", "sum")])
        totals = sums.select([*GROUP, "fare_sum_sum", "trip_count_sum"]).rename_columns(
            [*GROUP, "fare_sum", "trip_count"]
        )
    if totals is not None:
        yield from totals.combine_chunks().to_batches()


class FareWindows(StatefulProcessor):
    """Totals of one (hour, window) with its two timers: window end, and end of lateness."""

    def __init__(self, window_ms: int, lateness_ms: int, floor_ms: int = 0) -> None:
        self.window_ms = window_ms
        self.lateness_ms = lateness_ms
        #: The watermark of the query this one goes on for.
        self.floor_ms = floor_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", STATE_SCHEMA)

    def _row(self, key, fare_sum: float, trip_count: int, kind: str) -> Row:
        return Row(
            hour=key[0],
            window_ms=key[1],
            average_fare=fare_sum / trip_count,
            trip_count=trip_count,
            kind=kind,
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        added, arrived = 0.0, 0
        for row in rows:
            added += row.fare_sum
            arrived += row.trip_count
        now = max(timerValues.getCurrentWatermarkInMs(), self.floor_ms)
        end = key[1] + self.window_ms
        if now >= end + self.lateness_ms:
            yield self._row(key, added, arrived, "drop")
            return
        held = self.totals.get() if self.totals.exists() else None
        fare_sum, trip_count, fired = held or (0.0, 0, False)
        due = now >= end
        if due and held and not fired:
            # The end was reached before these rows came: report without them first.
            yield self._row(key, fare_sum, trip_count, "ontime")
        fare_sum, trip_count = fare_sum + added, trip_count + arrived
        if due:
            yield self._row(key, fare_sum, trip_count, "refire")
        self.totals.update((fare_sum, trip_count, fired or due))
        if held is None:
            self._register(end, due)

    def _register(self, end: int, fired: bool) -> None:
        """A timer is due when the watermark is past it, hence the millisecond less."""
        if not fired:
            self.handle.registerTimer(end - 1)
        self.handle.registerTimer(end + self.lateness_ms - 1)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """A window of the query this one goes on for."""
        self.totals.update((initialState.fare_sum, initialState.trip_count, initialState.fired))
        self._register(key[1] + self.window_ms, initialState.fired)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.totals.exists():
            return
        fare_sum, trip_count, fired = self.totals.get()
        if not fired:
            yield self._row(key, fare_sum, trip_count, "ontime")
            self.totals.update((fare_sum, trip_count, True))
        end = key[1] + self.window_ms
        if expiredTimerInfo.getExpiryTimeInMs() >= end + self.lateness_ms - 1:
            self.totals.clear()

    def close(self) -> None:
        pass


def window_totals(thin: DataFrame, combine: int = COMBINE) -> DataFrame:
    """Totals of (hour, window_ms, fare): at most ``combine`` rows per window from any number of tasks."""
    salted = thin.mapInArrow(add_up, PARTIAL_SCHEMA).withColumn(
        "salt", F.spark_partition_id() % combine
    )
    dealt = salted.repartition(combine, *GROUP, "salt").drop("salt")
    return dealt.mapInArrow(add_up, PARTIAL_SCHEMA)


def late_hourly(
    lines: DataFrame,
    event_time: str = "timestamp",
    disorder_seconds: int = DISORDER_SECONDS,
    lateness_seconds: int = LATENESS_SECONDS,
    combine: int = COMBINE,
    moved: MovedState | None = None,
) -> DataFrame:
    """The fired rows of the hourly aggregate with their ``kind``.

    Needs the RocksDB state store (``session.SETTINGS``). The partial totals
    carry no watermarked column, so no late row disappears on the way: every
    one of them is either counted or reported as dropped.
    """
    clock = F.unix_millis(EVENT_TIME)
    size = WINDOW_SECONDS * 1000
    thin = timed_trips(lines, event_time, disorder_seconds).select(
        hour_of_day(F.col("pickup_datetime")).alias("hour"),
        (clock - F.pmod(clock, F.lit(size))).alias("window_ms"),
        "fare_amount",
    )
    events = (
        window_totals(thin, combine)
        .groupBy(*GROUP)
        .transformWithState(
            statefulProcessor=FareWindows(size, lateness_seconds * 1000, moved.watermark_ms if moved else 0),
            outputStructType=EVENT_SCHEMA,
            outputMode="Update",
            timeMode="EventTime",
            initialState=moved.windows.groupBy(*GROUP) if moved else None,
        )
    )
    start = F.timestamp_millis("window_ms")
    return events.select(
        "hour",
        start.cast("timestamp_ntz").alias("window_start"),
        F.timestamp_millis(F.col("window_ms") + size).cast("timestamp_ntz").alias("window_end"),
        "average_fare",
        "trip_count",
        "kind",
    )
