"""A caller's own window function on a stream, with on-time rows, re-fires and drops.

The function is the same ``WindowFunction`` that ``operators.window_apply`` runs on
tables. Its ``start`` condenses rows in the tasks that read them, its ``merge`` joins
the condensed rows of a group, first by salt and then in the state, and its ``finish``
makes the columns of each emission. The state of a window is what the function
declares, whatever the number of its rows.

A window emits like the built-in aggregate of ``streaming.lateness``: ``ontime`` once
the watermark reaches its end, ``refire`` with everything so far for each batch of late
rows, and ``drop`` with what came after its state was cleared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from meterline.functions.clock import hour_of_day
from meterline.operators.window_apply import ARROW_TYPES, MEAN_FARE, WindowFunction
from meterline.session import ship_by_value
from meterline.streaming.clock import (
    DISORDER_SECONDS,
    EVENT_TIME,
    LATENESS_SECONDS,
    WINDOW_SECONDS,
    timed_trips,
)
from meterline.streaming.lateness import COMBINE, GROUP

ship_by_value(__name__)

GROUP_DDL = "hour INT, window_ms BIGINT"
#: Condensed rows a task holds before it joins them.
HELD_ROWS = 10_000

Step = Callable[[pd.DataFrame, np.ndarray, int], dict[str, np.ndarray]]


def fields_of(ddl: str) -> list[tuple[str, pa.DataType]]:
    return [(field.name, ARROW_TYPES[field.dataType]) for field in T.StructType.fromDDL(ddl).fields]


def plain(value, kind: pa.DataType):
    """A value of a step's array as a state or a row holds it; a missing one is None, NaN stays."""
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if pa.types.is_floating(kind):
        return float(value)
    if isinstance(value, float) and np.isnan(value):
        return None
    if pa.types.is_integer(kind):
        return int(value)
    if pa.types.is_boolean(kind):
        return bool(value)
    if pa.types.is_timestamp(kind):
        return pd.Timestamp(value).to_pydatetime()
    if pa.types.is_date(kind):
        return value if not isinstance(value, (pd.Timestamp, np.datetime64)) else pd.Timestamp(value).date()
    return value


def columns_of(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pd.DataFrame:
    """Rows as the frame a step is given, with the same types as a frame made from Arrow."""
    parts = zip(*rows) if rows else [()] * len(fields)
    arrays = [pa.array(part, kind, from_pandas=False) for part, (_, kind) in zip(parts, fields)]
    return pa.Table.from_arrays(arrays, names=[name for name, _ in fields]).to_pandas()


def rows_of(made: dict[str, np.ndarray], fields: list[tuple[str, pa.DataType]]) -> list[tuple]:
    return list(zip(*([plain(value, kind) for value in made[name]] for name, kind in fields)))


def condensed(function: WindowFunction, started: bool):
    """A row per group of one task, in the function's state columns; the task holds no more.

    Rows not ``started`` are the caller's own, else they are states of other tasks.
    """
    fields = fields_of(f"{GROUP_DDL}, {function.state}")
    states = [name for name, _ in fields[len(GROUP) :]]

    def grouped(frame: pd.DataFrame, step: Step, given: list[str]) -> pa.Table:
        keys = frame[GROUP].drop_duplicates(ignore_index=True)
        group = frame.groupby(GROUP, sort=False).ngroup().to_numpy()
        made = step(frame[given], group, len(keys))
        columns = [pa.array(keys[name], kind) for name, kind in fields[: len(GROUP)]]
        for name, kind in fields[len(GROUP) :]:
            columns.append(pa.array([plain(value, kind) for value in made[name]], kind, from_pandas=False))
        return pa.Table.from_arrays(columns, schema=pa.schema(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, limit = None, HELD_ROWS
        for batch in batches:
            if not batch.num_rows:
                continue
            if started:
                made = pa.Table.from_batches([batch]).rename_columns([name for name, _ in fields])
            else:
                made = grouped(batch.to_pandas(), function.start, list(function.columns))
            held = made if held is None else pa.concat_tables([held, made])
            if held.num_rows > limit:
                held = grouped(held.to_pandas(), function.merge, states)
                limit = max(HELD_ROWS, 2 * held.num_rows)
        if held is not None:
            yield from grouped(held.to_pandas(), function.merge, states).combine_chunks().to_batches()

    return run


class AppliedWindows(StatefulProcessor):
    """The state of one (hour, window) as the caller declares it, and two timers: its end, and that of lateness."""

    def __init__(self, function: WindowFunction, window_ms: int, lateness_ms: int) -> None:
        self.function = function
        self.window_ms = window_ms
        self.lateness_ms = lateness_ms
        # Parsed here: a worker has no session to parse declarations with.
        self.state = fields_of(function.state)
        self.result = fields_of(function.result)

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", f"{self.function.state}, fired BOOLEAN")

    def joined(self, rows: list[tuple]) -> tuple:
        """The states of one group as one."""
        frame = columns_of(rows, self.state)
        return rows_of(self.function.merge(frame, np.zeros(len(rows), dtype=np.int64), 1), self.state)[0]

    def row(self, key, state: tuple, kind: str) -> pd.DataFrame:
        hour, window_ms = (int(part) for part in key)
        made = self.function.finish(columns_of([state], self.state))
        frame = columns_of(rows_of(made, self.result), self.result)
        return frame.assign(hour=np.int32(hour), window_ms=window_ms, kind=kind)[["hour", "window_ms", *frame.columns, "kind"]]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = [name for name, _ in self.state]
        arrived: list[tuple] = []
        for frame in rows:
            arrived += rows_of({name: frame[name].to_numpy() for name in names}, self.state)
        added = self.joined(arrived)
        now = timerValues.getCurrentWatermarkInMs()
        end = int(key[1]) + self.window_ms
        if now >= end + self.lateness_ms:
            yield self.row(key, added, "drop")
            return
        held = self.held.get() if self.held.exists() else None
        before, fired = (held[:-1], held[-1]) if held else (None, False)
        due = now >= end
        if due and held and not fired:
            # The end was reached before these rows came: report without them first.
            yield self.row(key, before, "ontime")
        state = added if before is None else self.joined([tuple(before), added])
        if due:
            yield self.row(key, state, "refire")
        self.held.update((*state, fired or due))
        if held is None:
            # A timer is due when the watermark is past it, hence the millisecond less.
            if not due:
                self.handle.registerTimer(end - 1)
            self.handle.registerTimer(end + self.lateness_ms - 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.held.exists():
            return
        *state, fired = self.held.get()
        if not fired:
            yield self.row(key, tuple(state), "ontime")
            self.held.update((*state, True))
        if expiredTimerInfo.getExpiryTimeInMs() >= int(key[1]) + self.window_ms + self.lateness_ms - 1:
            self.held.clear()

    def close(self) -> None:
        pass


def apply_window_stream(
    lines: DataFrame,
    function: WindowFunction = MEAN_FARE,
    event_time: str = "timestamp",
    disorder_seconds: int = DISORDER_SECONDS,
    lateness_seconds: int = LATENESS_SECONDS,
    combine: int = COMBINE,
) -> DataFrame:
    """The function's result columns per emission of a pickup hour and one-hour window, with the ``kind``.

    Needs the RocksDB state store (``session.SETTINGS``). However crowded a window is, at
    most ``combine`` condensed rows of it reach the state in a batch. ``merge`` is called
    on states in no fixed order.
    """
    clock = F.unix_millis(EVENT_TIME)
    size = WINDOW_SECONDS * 1000
    thin = timed_trips(lines, event_time, disorder_seconds).select(
        hour_of_day(F.col("pickup_datetime")).alias("hour"),
        (clock - F.pmod(clock, F.lit(size))).alias("window_ms"),
        *function.columns,
    )
    state = f"{GROUP_DDL}, {function.state}"
    started = thin.mapInArrow(condensed(function, started=False), state)
    salted = started.withColumn("salt", F.spark_partition_id() % combine)
    dealt = salted.repartition(combine, *GROUP, "salt").drop("salt")
    fewer = dealt.mapInArrow(condensed(function, started=True), state)
    events = fewer.groupBy(*GROUP).transformWithStateInPandas(
        statefulProcessor=AppliedWindows(function, size, lateness_seconds * 1000),
        outputStructType=T.StructType.fromDDL(f"{GROUP_DDL}, {function.result}, kind STRING"),
        outputMode="Update",
        timeMode="EventTime",
    )
    start = F.timestamp_millis("window_ms").cast("timestamp_ntz")
    return events.select(
        "hour",
        start.alias("window_start"),
        (start + F.lit(timedelta(seconds=WINDOW_SECONDS))).alias("window_end"),
        *(field.name for field in T.StructType.fromDDL(function.result).fields),
        "kind",
    )
