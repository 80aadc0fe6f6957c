from __future__ import annotations

import os
import random
from collections import defaultdict
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import HEADER, trip_line
from meterline.operators.hourly import hourly_fares, latest
from meterline.operators.parse import parse_trips
from meterline.plans.pipeline import (
    Outputs,
    start_hourly,
    start_late_hourly,
    start_pipeline,
    start_trips,
)
from meterline.schemas import DECODED, HOURLY, MESSAGE, TRIP
from meterline.sinks.tables import hourly_sink, read_table, write_batch
from meterline.sinks.topic import console
from meterline.sources.files import line_file_stream, message_stream
from meterline.streaming.clock import timed_trips
from meterline.streaming.lateness import window_totals

DAY = datetime(2025, 1, 1)


def test_totals_that_reach_the_state_are_bounded_by_windows(spark):
    thin = spark.range(0, 64_000, 1, 64).selectExpr(
        "CAST(id % 5 AS INT) hour", "id % 3 * 3600000 window_ms", "CAST(id AS DOUBLE) fare_amount"
    )
    totals = window_totals(thin, combine=4)
    assert totals.count() <= 15 * 4
    assert totals.agg(F.sum("trip_count"), F.sum("fare_sum")).first()[:] == (64_000, 64_000 * 63_999 / 2)


def message(moment: datetime, fare: float = 1.0, pickup: datetime | None = None):
    text = trip_line(
        tpep_pickup_datetime=f"{pickup or moment:%Y-%m-%d %H:%M:%S}",
        tpep_dropoff_datetime=f"{moment:%Y-%m-%d %H:%M:%S}",
        fare_amount=str(fare),
    )
    return text, moment


class Feed:
    """Message files that a stream takes one per batch, in the order they were added."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.files = spark, str(folder), 0

    def add(self, messages):
        part = f"{self.folder}-part-{self.files}"
        frame = self.spark.createDataFrame(messages, MESSAGE)
        frame.coalesce(1).write.parquet(part)
        (source,) = [name for name in os.listdir(part) if name.endswith(".parquet")]
        os.makedirs(self.folder, exist_ok=True)
        target = f"{self.folder}/{self.files:04}.parquet"
        with open(f"{part}/{source}", "rb") as old, open(target, "wb") as new:
            new.write(old.read())
        os.utime(target, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1

    def stream(self):
        return message_stream(self.spark, self.folder, files_per_batch=1)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "feed")


def emitted(spark, feed, tmp_path, **runs):
    """Everything the lateness operator emits, in order of batches."""
    table = str(tmp_path / "events")
    query = start_late_hourly(
        feed.stream(),
        lambda frame, batch: write_batch(frame, table, batch),
        str(tmp_path / "state"),
        interval=None,
        **runs,
    )
    query.awaitTermination()
    return spark.read.parquet(table).orderBy("batch_id").collect()


def at(text: str) -> datetime:
    return datetime.fromisoformat(f"2025-01-01 {text}")


def test_lateness_drill(spark, feed, tmp_path):
    for times in (
        ["00:10:00", "00:50:00"],
        ["01:00:11"],
        ["00:59:00"],
        ["01:05:11"],
        ["00:58:00"],
        ["01:06:00"],
    ):
        feed.add([message(at(time), fare=float(i)) for i, time in enumerate(times, 1)])
    rows = emitted(spark, feed, tmp_path)
    assert [(r.kind, r.hour, r.trip_count) for r in rows] == [
        ("ontime", 0, 2),
        ("refire", 0, 3),
        ("drop", 0, 1),
    ]
    assert {r.window_start for r in rows} == {DAY}
    assert [r.average_fare for r in rows] == [1.5, pytest.approx(4 / 3), 1.0]


def test_limits_of_the_lateness_drill(spark, feed, tmp_path):
    """The window fires at end + 10 s exactly and is cleared at end + 310 s exactly."""
    feed.add([message(at("00:10:00"))])
    feed.add([message(at("01:00:09"))])
    feed.add([message(at("00:11:00"))])
    feed.add([message(at("01:00:10"))])
    feed.add([message(at("00:12:00"))])
    feed.add([message(at("01:05:09"))])
    feed.add([message(at("00:13:00"))])
    feed.add([message(at("01:05:10"))])
    feed.add([message(at("00:14:00"))])
    rows = emitted(spark, feed, tmp_path)
    assert [(r.kind, r.trip_count) for r in rows] == [
        ("ontime", 2),
        ("refire", 3),
        ("refire", 4),
        ("drop", 1),
    ]


def simulate(batches):
    """The emission rule row by row: a plain-Python second reading."""
    newest, held, fired, found = datetime.min, {}, set(), []
    hour = timedelta(hours=1)
    for batch in batches:
        mark = newest - timedelta(seconds=10) if newest > datetime.min else newest
        grouped = defaultdict(list)
        for moment, pickup, fare in batch:
            start = moment.replace(minute=0, second=0)
            grouped[pickup.hour, start].append(fare)
            newest = max(newest, moment)
        for key in sorted(set(held) | set(grouped)):
            end = key[1] + hour
            if key in held and mark >= end and key not in fired:
                found.append(("ontime", *key, len(held[key])))
                fired.add(key)
            fares = grouped.get(key)
            if fares and mark >= end + timedelta(minutes=5):
                found.append(("drop", *key, len(fares)))
            elif fares:
                held.setdefault(key, []).extend(fares)
                if mark >= end:
                    found.append(("refire", *key, len(held[key])))
                    fired.add(key)
    mark = newest - timedelta(seconds=10)
    for key, fares in held.items():
        if mark >= key[1] + hour and key not in fired:
            found.append(("ontime", *key, len(fares)))
    return sorted(found)


def test_lateness_against_a_simulation(spark, feed, tmp_path):
    rng = random.Random(3)
    batches, clock = [], DAY
    for _ in range(10):
        clock += timedelta(minutes=rng.choice([3, 4, 20, 58]))
        batch = []
        for _ in range(40):
            lag = rng.choice([0, 0, 30, 200, 400, 3700, 8000])
            moment = max(DAY, clock - timedelta(seconds=rng.randrange(lag + 1)))
            pickup = moment - timedelta(minutes=rng.choice([0, 0, 0, 30]))
            batch.append((moment, pickup, float(rng.randrange(100))))
        batches.append(batch)
        feed.add([message(moment, fare, pickup) for moment, pickup, fare in batch])
    rows = emitted(spark, feed, tmp_path)
    found = sorted((r.kind, r.hour, r.window_start, r.trip_count) for r in rows)
    assert found == simulate(batches)
    assert {kind for kind, *_ in found} == {"ontime", "refire", "drop"}


def test_rejected_lines_move_the_record_clock(spark, feed, tmp_path):
    feed.add([message(at("00:10:00"))])
    feed.add([("not a trip", at("02:00:00"))])
    feed.add([message(at("00:20:00"))])
    rows = emitted(spark, feed, tmp_path)
    assert sorted((r.kind, r.trip_count) for r in rows) == [("drop", 1), ("ontime", 1)]


def test_pickup_clock(spark, feed, tmp_path):
    feed.add([message(at("00:10:00"))])
    feed.add([message(DAY + timedelta(days=3), pickup=at("00:20:00"))])
    feed.add([message(DAY, pickup=at("01:30:00"))])
    rows = emitted(spark, feed, tmp_path, event_time="pickup_datetime")
    assert [(r.kind, r.hour, r.trip_count) for r in rows] == [("ontime", 0, 2)]


def test_stream_equals_batch(spark, feed, tmp_path):
    rng = random.Random(5)
    for part in range(6):
        moments = [
            DAY + timedelta(hours=2 * part, seconds=rng.randrange(7200)) for _ in range(50)
        ]
        feed.add([message(m, rng.uniform(-5, 50), m - timedelta(minutes=30)) for m in moments])
    table = str(tmp_path / "hourly")
    query = start_hourly(feed.stream(), hourly_sink(table), str(tmp_path / "state"), interval=None)
    query.awaitTermination()
    assert query.name == "hourly-fares"
    assert len(query.recentProgress) >= 6
    streamed = latest(read_table(spark, table, HOURLY)).orderBy("window_start", "hour").collect()
    lines = spark.read.schema(MESSAGE).parquet(feed.folder)
    batch = hourly_fares(parse_trips(lines)).orderBy("window_start", "hour").collect()
    assert len(streamed) == len(batch) > 12
    for ours, theirs in zip(streamed, batch):
        assert ours[:3] == theirs[:3]
        assert ours.trip_count == theirs.trip_count
        assert ours.average_fare == pytest.approx(theirs.average_fare)


def test_update_stream_drops_rows_past_the_lateness(spark, feed, tmp_path):
    for times in (["00:10:00"], ["01:05:11"], ["01:06:00"], ["00:58:00"], ["01:07:00"]):
        feed.add([message(at(time)) for time in times])
    table = str(tmp_path / "hourly")
    query = start_hourly(feed.stream(), hourly_sink(table), str(tmp_path / "state"), interval=None)
    query.awaitTermination()
    found = {r.window_start.hour: r.trip_count for r in latest(read_table(spark, table, HOURLY)).collect()}
    assert found == {0: 1, 1: 3}
    dropped = sum(p.stateOperators[0].numRowsDroppedByWatermark for p in query.recentProgress)
    assert dropped == 1


def test_pipeline_tables(spark, feed, tmp_path):
    feed.add([message(at("00:10:00"), 4.0), (HEADER, at("00:11:00")), ("", at("00:11:30"))])
    feed.add([message(at("09:00:00"), 6.0)])
    # Late by hours: missing from the hourly table, present in the trip tables.
    feed.add([message(at("00:20:00"), 8.0)])
    root = str(tmp_path / "out")
    queries = start_pipeline(
        feed.stream(), Outputs.below(root), str(tmp_path / "state"), interval=None
    )
    for query in queries:
        query.awaitTermination()
    raw = read_table(spark, f"{root}/taxi_trips", TRIP)
    assert sorted(r.fare_amount for r in raw.collect()) == [4.0, 6.0, 8.0]
    decoded = read_table(spark, f"{root}/yellow_taxi_stream", DECODED)
    assert decoded.count() == 3
    assert {r.vendor_name for r in decoded.collect()} == {"Creative Mobile Technologies, LLC"}
    rejected = spark.read.parquet(f"{root}/rejects")
    assert sorted(r.reason for r in rejected.collect()) == ["blank", "header"]
    hourly = latest(read_table(spark, f"{root}/hourly_aggregates", HOURLY)).collect()
    assert [(r.hour, r.trip_count, r.average_fare) for r in hourly] == [(0, 1, 4.0)]
    drops = read_table(spark, f"{root}/late_drops", HOURLY).collect()
    assert [(r.hour, r.trip_count, r.average_fare) for r in drops] == [(0, 1, 8.0)]


def test_pipeline_keeps_wide_flags_out_of_a_database(spark, feed, tmp_path):
    moment = at("00:10:00")
    feed.add([(trip_line(store_and_fwd_flag=flag), moment) for flag in ("Y", "YY")])
    seen = {}

    def catch(name):
        return lambda frame, _: seen.update({name: frame.collect()})

    names = ("raw", "decoded", "rejected", "hourly", "dropped")
    outputs = Outputs(*map(catch, names), narrow_flags=True)
    start_trips(feed.stream(), outputs, str(tmp_path / "state"), interval=None).awaitTermination()
    assert [r.store_and_fwd_flag for r in seen["raw"]] == ["Y"]
    assert len(seen["decoded"]) == 1
    assert [r.reason for r in seen["rejected"]] == ["flag_width"]
    assert Outputs.database("jdbc:x", str(tmp_path), connection={"user": "u"}).narrow_flags


def test_pipeline_goes_on_after_a_restart(spark, feed, tmp_path):
    outputs, state = Outputs.below(str(tmp_path / "out")), str(tmp_path / "state")
    for fare in (1.0, 2.0):
        feed.add([message(at("00:10:00"), fare)])
        start_trips(feed.stream(), outputs, state, interval=None).awaitTermination()
    raw = read_table(spark, f"{tmp_path}/out/taxi_trips", TRIP)
    assert sorted((r.batch_id, r.fare_amount) for r in raw.collect()) == [(0, 1.0), (1, 2.0)]


def test_a_batch_that_failed_half_way_is_not_doubled(spark, feed, tmp_path):
    good = Outputs.below(str(tmp_path / "out"))

    def broken(frame, batch_id):
        raise RuntimeError("disk full")

    feed.add([message(at("00:10:00"), 1.0), message(at("00:11:00"), 2.0)])
    state = str(tmp_path / "state")
    query = start_trips(feed.stream(), replace(good, decoded=broken), state, interval=None)
    with pytest.raises(Exception, match="disk full"):
        query.awaitTermination()
    start_trips(feed.stream(), good, state, interval=None).awaitTermination()
    for name, schema in (("taxi_trips", TRIP), ("yellow_taxi_stream", DECODED)):
        stored = read_table(spark, f"{tmp_path}/out/{name}", schema).collect()
        assert sorted(r.fare_amount for r in stored) == [1.0, 2.0]


def test_hourly_state_survives_a_restart(spark, feed, tmp_path):
    table, state = str(tmp_path / "events"), str(tmp_path / "state")

    def run():
        start_late_hourly(
            feed.stream(), lambda frame, batch: write_batch(frame, table, batch), state, interval=None
        ).awaitTermination()

    for part in (["00:10:00"], ["00:20:00"], ["01:00:30"], ["00:30:00"]):
        feed.add([message(at(time)) for time in part])
        run()
    found = sorted((r.kind, r.trip_count) for r in spark.read.parquet(table).collect())
    assert found == [("ontime", 2), ("refire", 3)]


def test_text_stream_has_the_file_time(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path = tmp_path / "in" / "lines.csv"
    path.write_text(HEADER + "\r\n" + trip_line() + "\r\n")
    os.utime(path, (1_700_000_000, 1_700_000_000))
    seen = []
    query = (
        line_file_stream(spark, str(tmp_path / "in"), files_per_batch=1)
        .writeStream.foreachBatch(lambda frame, _: seen.extend(frame.collect()))
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert [r.value for r in seen] == [HEADER, trip_line()]
    assert {r.timestamp for r in seen} == {datetime(2023, 11, 14, 22, 13, 20)}


def test_console_print_is_named(spark, feed, tmp_path):
    feed.add([message(at("00:10:00"))])
    query = console(parse_trips(feed.stream()), "final-trip").trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.name == "final-trip"
    assert query.exception() is None


def test_clock_needs_utc(spark, feed):
    feed.add([message(DAY)])
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        with pytest.raises(ValueError, match="UTC"):
            timed_trips(feed.stream())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_settings_return_to_what_they_were(spark, feed, tmp_path):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    feed.add([message(DAY)])
    sink = hourly_sink(str(tmp_path / "hourly"))
    start_hourly(feed.stream(), sink, str(tmp_path / "state"), interval=None).awaitTermination()
    assert spark.conf.get(key) == before
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"
