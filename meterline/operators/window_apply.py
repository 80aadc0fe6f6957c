"""A caller's own function over all trips of each (hour, window).

The function comes in three steps so that no task ever holds a whole window:
``start`` condenses rows, ``merge`` joins such results, and ``finish`` turns the last
ones into output columns. Each step is called for many groups at a time: it gets a
frame, the number of each row's group and how many groups there are, and gives an
array per column with a value for each group. For mean and count use
``hourly_fares``, which needs no Python at all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions.clock import hour_of_day
from meterline.session import ship_by_value

ship_by_value(__name__)

GROUP = ["hour", "window_start", "window_end"]
GROUP_DDL = "hour INT, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ"

# Results of many tasks are merged in this many parts per group before the last merge.
MERGE_PARTS = 32

Arrays = dict[str, np.ndarray]


@dataclass(frozen=True)
class WindowFunction:
    """``columns`` of the trips go in; state and result columns are declared as DDL."""

    columns: tuple[str, ...]
    state: str
    result: str
    start: Callable[[pd.DataFrame, np.ndarray, int], Arrays]
    merge: Callable[[pd.DataFrame, np.ndarray, int], Arrays]
    finish: Callable[[pd.DataFrame], Arrays]


def _fare_start(rows: pd.DataFrame, group: np.ndarray, groups: int) -> Arrays:
    return {
        "fare_sum": np.bincount(group, rows["fare_amount"], groups),
        "trip_count": np.bincount(group, minlength=groups),
    }


def _fare_merge(states: pd.DataFrame, group: np.ndarray, groups: int) -> Arrays:
    count = np.zeros(groups, np.int64)
    np.add.at(count, group, states["trip_count"].to_numpy(np.int64))
    return {"fare_sum": np.bincount(group, states["fare_sum"], groups), "trip_count": count}


def _fare_finish(states: pd.DataFrame) -> Arrays:
    return {
        "average_fare": (states["fare_sum"] / states["trip_count"]).to_numpy(),
        "trip_count": states["trip_count"].to_numpy(),
    }


MEAN_FARE = WindowFunction(
    columns=("fare_amount",),
    state="fare_sum DOUBLE, trip_count BIGINT",
    result="average_fare DOUBLE, trip_count BIGINT",
    start=_fare_start,
    merge=_fare_merge,
    finish=_fare_finish,
)


ARROW_TYPES = {
    T.IntegerType(): pa.int32(),
    T.LongType(): pa.int64(),
    T.DoubleType(): pa.float64(),
    T.StringType(): pa.string(),
    T.BooleanType(): pa.bool_(),
    T.DateType(): pa.date32(),
    T.TimestampNTZType(): pa.timestamp("us"),
}


def _arrow_schema(ddl: str) -> pa.Schema:
    fields = T.StructType.fromDDL(ddl).fields
    return pa.schema([(field.name, ARROW_TYPES[field.dataType]) for field in fields])


def _grouped(frame: pd.DataFrame, step: Callable[[pd.DataFrame, np.ndarray, int], Arrays]) -> pd.DataFrame:
    """The keys of the frame's groups, in order of first rows, with the step's columns."""
    keys = frame[GROUP].drop_duplicates(ignore_index=True)
    group = frame.groupby(GROUP, sort=False, dropna=False).ngroup().to_numpy()
    return keys.assign(**step(frame, group, len(keys)))


def _arrow(frame: pd.DataFrame, schema: pa.Schema) -> list[pa.RecordBatch]:
    """Batches of the schema; NaN stays NaN and is not taken for NULL."""
    columns = [
        pa.array(frame[field.name].to_numpy(), field.type, from_pandas=False)
        if field.type == pa.float64()
        else pa.array(frame[field.name], field.type)
        for field in schema
    ]
    return pa.Table.from_arrays(columns, schema=schema).to_batches()


def apply_window(
    trips: DataFrame, event_time: str = "timestamp", function: WindowFunction = MEAN_FARE
) -> DataFrame:
    """The function's result columns per pickup hour and one-hour window of ``event_time``."""
    keyed = trips.select(
        hour_of_day(F.col("pickup_datetime")).alias("hour"),
        F.window(event_time, "1 hour").alias("window"),
        *function.columns,
    ).select(
        "hour",
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *function.columns,
    )

    state = f"{GROUP_DDL}, {function.state}"
    result = f"{GROUP_DDL}, {function.result}"
    state_schema, result_schema = _arrow_schema(state), _arrow_schema(result)

    def condense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _arrow(_grouped(batch.to_pandas(), function.start), state_schema)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        """States of rows that come sorted by group; a group that a batch cuts is held back."""
        held = None
        for batch in batches:
            if batch.num_rows:
                states = batch.select(state_schema.names).to_pandas()
                states = states if held is None else pd.concat([held, states], ignore_index=True)
                states = _grouped(states, function.merge)
                held = states.iloc[-1:]
                yield states.iloc[:-1]
        if held is not None:
            yield held

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for states in merged(batches):
            yield from _arrow(states, state_schema)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for states in merged(batches):
            if len(states):
                found = states[GROUP].assign(**function.finish(states))
                yield from _arrow(found, result_schema)

    parts = keyed.mapInArrow(condense, state).withColumn(
        "part", F.spark_partition_id() % MERGE_PARTS
    )
    fewer = parts.repartition(*GROUP, "part").sortWithinPartitions(*GROUP).mapInArrow(merge, state)
    return fewer.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(finish, result)
