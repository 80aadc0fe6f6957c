from __future__ import annotations

import math
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE, trip_line
from meterline.operators.hourly import hourly_fares, latest, overall_fare
from meterline.operators.parse import parse_trips
from meterline.operators.window_apply import WindowFunction, apply_window
from meterline.schemas import HOURLY


def test_sample_hour(lines):
    frame = hourly_fares(parse_trips(lines(*SAMPLE)), "pickup_datetime")
    assert frame.schema.simpleString() == HOURLY.simpleString()
    (row,) = frame.collect()
    assert (row.hour, row.trip_count) == (0, 4)
    assert row.window_start == datetime(2025, 1, 1)
    assert row.window_end == datetime(2025, 1, 1, 1)
    assert row.average_fare == pytest.approx(38.5 / 4)


def test_hour_and_window_follow_different_clocks(spark):
    rows = [(line, datetime(2025, 6, 1, 12, 30)) for line in SAMPLE]
    rows.append((trip_line(tpep_pickup_datetime="2025-01-05 07:00:00.000000"), rows[0][1]))
    frame = spark.createDataFrame(rows, "value STRING, timestamp TIMESTAMP")
    found = hourly_fares(parse_trips(frame)).orderBy("hour").collect()
    assert [(r.hour, r.trip_count) for r in found] == [(0, 4), (7, 1)]
    assert {r.window_start for r in found} == {datetime(2025, 6, 1, 12)}


def test_zoned_record_times_need_utc(spark):
    frame = spark.createDataFrame(
        [(SAMPLE[0], datetime(2025, 1, 1))], "value STRING, timestamp TIMESTAMP"
    )
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        with pytest.raises(ValueError, match="UTC"):
            hourly_fares(parse_trips(frame))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_nan_reaches_the_mean(lines):
    texts = [SAMPLE[0], trip_line(fare_amount="NaN")]
    row = hourly_fares(parse_trips(lines(*texts)), "pickup_datetime").first()
    assert math.isnan(row.average_fare)
    row = apply_window(parse_trips(lines(*texts)), "pickup_datetime").first()
    assert math.isnan(row.average_fare)


def test_empty_input(lines):
    none = parse_trips(lines("x"))
    assert hourly_fares(none, "pickup_datetime").count() == 0
    assert overall_fare(none).first().asDict() == {"average_fare": 0.0, "trip_count": 0}


def test_latest_row_of_a_change_log(spark):
    at, end = datetime(2025, 1, 1), datetime(2025, 1, 1, 1)
    log = [
        (0, at, end, 1.0, 5, 3),
        (0, at, end, 2.0, 7, 10),
        (0, at, end, 3.0, 6, 10),
        (1, at, end, 4.0, 1, 0),
    ]
    frame = spark.createDataFrame(
        log,
        "hour INT, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, "
        "average_fare DOUBLE, trip_count BIGINT, batch_id BIGINT",
    )
    found = {r.hour: r for r in latest(frame).collect()}
    assert (found[0].average_fare, found[0].trip_count) == (2.0, 7)
    assert (found[1].average_fare, found[1].window_end) == (4.0, end)


def test_latest_row_over_runs_whose_batches_start_anew(spark):
    at, end = datetime(2025, 1, 1), datetime(2025, 1, 1, 1)
    first, second = datetime(2025, 1, 1, 2), datetime(2025, 1, 1, 3)
    log = [(0, at, end, 1.0, 5, first, 7), (0, at, end, 2.0, 3, second, 0)]
    frame = spark.createDataFrame(
        log,
        "hour INT, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, "
        "average_fare DOUBLE, trip_count BIGINT, written_at TIMESTAMP, batch_id BIGINT",
    )
    assert latest(frame).first().average_fare == 2.0


def test_window_function_of_the_caller(spark):
    """Lowest and highest fare of each window, over many tasks and a crowded window."""
    extremes = WindowFunction(
        columns=("fare_amount",),
        state="low DOUBLE, high DOUBLE",
        result="spread DOUBLE",
        start=lambda rows, group, groups: {
            "low": rows.fare_amount.groupby(group).min().to_numpy(),
            "high": rows.fare_amount.groupby(group).max().to_numpy(),
        },
        merge=lambda states, group, groups: {
            "low": states.low.groupby(group).min().to_numpy(),
            "high": states.high.groupby(group).max().to_numpy(),
        },
        finish=lambda states: {"spread": (states.high - states.low).to_numpy()},
    )
    start = F.expr("TIMESTAMP_NTZ'2025-01-01 00:00:00'")
    trips = spark.range(0, 30000, 1, 50).select(
        F.when(F.col("id") % 3 == 0, start)
        .otherwise(start + F.make_dt_interval(secs=(F.col("id") * 10).cast("decimal(18,6)")))
        .alias("pickup_datetime"),
        F.col("id").cast("double").alias("fare_amount"),
    )
    expected = (
        trips.groupBy(F.window("pickup_datetime", "1 hour").alias("w"))
        .agg((F.max("fare_amount") - F.min("fare_amount")).alias("spread"))
        .select("w.start", "spread")
    )
    found = apply_window(trips, "pickup_datetime", extremes).select("window_start", "spread")
    assert sorted(found.collect()) == sorted(expected.collect())


def test_many_windows_cost_no_call_each(spark):
    """200,000 rows in 18,000 windows: the time of some batches, not of 18,000 groups."""
    start = F.expr("TIMESTAMP_NTZ'2023-01-01 00:00:00'")
    later = F.make_dt_interval(hours=(F.col("id") % 18_000).cast("int"))
    trips = spark.range(0, 200_000, 1, 8).select(
        (start + later).alias("pickup_datetime"), (F.col("id") % 7).cast("double").alias("fare_amount")
    )
    begun = time.monotonic()
    found = apply_window(trips, "pickup_datetime").agg(F.count("*"), F.sum("trip_count")).first()
    assert tuple(found) == (18_000, 200_000)
    assert time.monotonic() - begun < 60


def test_nan_fares_stay_nan_in_the_window_function(spark):
    rows = [(datetime(2025, 1, 1), 1.0), (datetime(2025, 1, 1), float("nan")), (datetime(2025, 1, 2), 3.0)]
    trips = spark.createDataFrame(rows, "pickup_datetime TIMESTAMP_NTZ, fare_amount DOUBLE")
    found = {r.window_start.day: r.average_fare for r in apply_window(trips, "pickup_datetime").collect()}
    assert found[1] != found[1] and found[1] is not None and found[2] == 3.0


def test_worker_code_travels_by_value():
    """Executors unpickle the functions without having the package."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from meterline.operators.window_apply import MEAN_FARE
    from meterline.streaming.lateness import FareWindows, add_up

    payload = cloudpickle.dumps((MEAN_FARE, add_up, FareWindows(1, 2))).hex()
    code = (
        "import sys; from pyspark import cloudpickle; "
        "found = cloudpickle.loads(bytes.fromhex(sys.stdin.read())); "
        "assert 'meterline' not in sys.modules; print(found[2].window_ms)"
    )
    done = subprocess.run(
        [sys.executable, "-c", code], input=payload, capture_output=True, text=True, cwd="/"
    )
    assert done.stdout.strip() == "1", done.stderr
