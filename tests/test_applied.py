"""A caller's window function on a stream: the built-in aggregate's emissions, and those of batch."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalog.windows import FARE_RANGE
from meterline.operators.parse import parse_trips
from meterline.operators.window_apply import MEAN_FARE, apply_window
from meterline.plans.pipeline import start_applied
from meterline.sinks.tables import write_batch
from meterline.sources.files import message_table
from meterline.streaming import applied
from test_streaming import at, emitted, feed, message  # noqa: F401

DRILL = (
    ["00:10:00", "00:50:00"],
    ["01:00:11"],
    ["00:59:00"],
    ["01:05:11"],
    ["00:58:00"],
    ["01:06:00"],
)


def applied_rows(spark, feed, tmp_path, function, **runs):  # noqa: F811
    table = str(tmp_path / "applied")
    start_applied(
        feed.stream(),
        function,
        lambda frame, batch: write_batch(frame, table, batch),
        str(tmp_path / "applied-state"),
        interval=None,
        **runs,
    ).awaitTermination()
    return spark.read.parquet(table).orderBy("batch_id", "kind")


def test_the_drill_of_the_built_in_aggregate(spark, feed, tmp_path):  # noqa: F811
    for times in DRILL:
        feed.add([message(at(time), fare=float(i)) for i, time in enumerate(times, 1)])
    ours = applied_rows(spark, feed, tmp_path, MEAN_FARE).collect()
    assert [(r.kind, r.hour, r.trip_count) for r in ours] == [("ontime", 0, 2), ("refire", 0, 3), ("drop", 0, 1)]
    columns = ["hour", "window_start", "window_end", "average_fare", "trip_count", "kind"]
    theirs = emitted(spark, feed, tmp_path)
    assert [tuple(row[c] for c in columns) for row in ours] == [tuple(row[c] for c in columns) for row in theirs]


def test_state_of_other_types_survives_restarts_and_equals_batch(spark, feed, tmp_path):  # noqa: F811
    """Each file is taken in by a query of its own; nulls, texts and times stay in the state between."""
    for number, times in enumerate((["00:10:00", "01:20:00"], ["00:50:00"], ["01:30:00", "00:55:00"])):
        feed.add([message(at(time), fare=float(i + number) - 2.5 * (i % 2)) for i, time in enumerate(times)])
        applied_rows(spark, feed, tmp_path, FARE_RANGE, disorder_seconds=7200)
    expected = apply_window(parse_trips(message_table(spark, feed.folder)), "timestamp", FARE_RANGE)
    expected = {(row["hour"], row["window_start"]): row.asDict() for row in expected.collect()}
    feed.add([("", at("23:59:00"))])
    rows = applied_rows(spark, feed, tmp_path, FARE_RANGE, disorder_seconds=7200).drop("run_id", "batch_id", "kind")
    assert {(row["hour"], row["window_start"]): row.asDict() for row in rows.collect()} == expected
    assert {row["refunds"] for row in expected.values()} == {None, "refunds"}


@pytest.mark.parametrize("held", [3, 10_000])
def test_tasks_hold_a_row_per_group(spark, monkeypatch, held):
    monkeypatch.setattr(applied, "HELD_ROWS", held)
    batches = [
        pa.RecordBatch.from_pydict({"hour": pa.array([n % 5] * 4, pa.int32()), "window_ms": [0, 0, 3_600_000, 0], "fare_amount": [1.0, 2.0, 3.0, 4.0]})
        for n in range(50)
    ]
    made = list(applied.condensed(MEAN_FARE, started=False)(iter(batches)))
    rows = [row for batch in made for row in batch.to_pylist()]
    assert len(rows) == 10 and sum(row["trip_count"] for row in rows) == 200
    assert sum(row["fare_sum"] for row in rows) == 500.0
    again = list(applied.condensed(MEAN_FARE, started=True)(iter(made * 2)))
    assert sum(batch.num_rows for batch in again) == 10


def test_the_state_gets_few_rows_of_a_crowded_window(spark):
    thin = spark.range(0, 64_000, 1, 64).select(
        F.lit(1).alias("hour"), F.lit(0).cast("long").alias("window_ms"), F.col("id").cast("double").alias("fare_amount")
    )
    state = f"{applied.GROUP_DDL}, {MEAN_FARE.state}"
    started = thin.mapInArrow(applied.condensed(MEAN_FARE, started=False), state)
    salted = started.withColumn("salt", F.spark_partition_id() % 4).repartition(4, "hour", "window_ms", "salt").drop("salt")
    fewer = salted.mapInArrow(applied.condensed(MEAN_FARE, started=True), state)
    assert fewer.count() <= 4 and fewer.agg(F.sum("trip_count")).first()[0] == 64_000
