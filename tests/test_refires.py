"""One emission per late row: the drill, a simulation, repeated batches, and what is left between batches."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from meterline.plans.pipeline import start_refires
from meterline.streaming import refires
from meterline.streaming.refires import running_totals
from test_streaming import DAY, at, feed, message  # noqa: F401


def fire(spark, feed, tmp_path, **settings):  # noqa: F811
    start_refires(feed.stream(), str(tmp_path / "events"), str(tmp_path / "state"), interval=None, **settings).awaitTermination()


def emissions(spark, tmp_path):
    rows = spark.read.parquet(str(tmp_path / "events")).orderBy("batch_id", "window_start", "trip_count").collect()
    return [(r.batch_id, r.kind, r.hour, r.window_start, r.trip_count, round(r.average_fare, 9)) for r in rows]


def simulated(batches, disorder=10, lateness=300):
    """(batch, kind, hour, window, count, mean) by the rule, row by row."""
    out, held, fired, newest = [], {}, set(), None
    for number, batch in enumerate(batches):
        mark = newest - timedelta(seconds=disorder) if newest else None
        lost = {}
        for moment, fare in sorted(batch):
            start = moment.replace(minute=0, second=0)
            end = start + timedelta(hours=1)
            if mark and mark >= end + timedelta(seconds=lateness):
                lost.setdefault(start, []).append(fare)
                continue
            held.setdefault(start, []).append(fare)
            if mark and mark >= end:
                out.append((number, "refire", start.hour, start, len(held[start]), round(sum(held[start]) / len(held[start]), 9)))
        out += [(number, "drop", w.hour, w, len(f), round(sum(f) / len(f), 9)) for w, f in lost.items()]
        newest = max([m for m, _ in batch] + ([newest] if newest else []))
        mark = newest - timedelta(seconds=disorder)
        for start, fares in held.items():
            late_already = any(row[3] == start and row[1] == "refire" for row in out)
            if mark >= start + timedelta(hours=1) and start not in fired:
                fired.add(start)
                if not late_already:
                    out.append((number, "ontime", start.hour, start, len(fares), round(sum(fares) / len(fares), 9)))
    return sorted(out, key=lambda row: (row[0], row[3], row[4]))


def test_every_late_row_fires(spark, feed, tmp_path):  # noqa: F811
    batches = [["00:10:00", "00:50:00"], ["01:00:11"], ["00:59:00", "00:20:00", "00:20:00"], ["01:05:11"], ["00:58:00", "00:57:00"], ["01:06:00"]]
    for times in batches:
        feed.add([message(at(time), fare=float(i)) for i, time in enumerate(times, 1)])
    fire(spark, feed, tmp_path)
    assert [row[1:3] + row[4:] for row in emissions(spark, tmp_path)] == [
        ("ontime", 0, 2, 1.5),
        ("refire", 0, 3, pytest.approx(5 / 3)),
        ("refire", 0, 4, 2.0),
        ("refire", 0, 5, 1.8),
        ("drop", 0, 2, 1.5),
    ]
    # Of what batches left, that of the last two is kept.
    left = {path.name for path in (tmp_path / "state" / "open-windows" / "clock").glob("run_id=*/batch_id=*")}
    assert left == {"batch_id=4", "batch_id=5"}


def test_against_a_simulation(spark, feed, tmp_path):  # noqa: F811
    rng = random.Random(12)
    batches = []
    for number in range(7):
        moments = {at("00:00:00") + timedelta(minutes=25 * number, seconds=rng.randrange(-6000, 1500)) for _ in range(25)}
        batches.append([(max(moment, DAY), float(rng.randrange(-20, 90))) for moment in sorted(moments)])
    batches = [list(dict(batch).items()) for batch in batches]
    for batch in batches:
        feed.add([message(moment, fare) for moment, fare in batch])
    fire(spark, feed, tmp_path, lateness_seconds=1800)
    found = emissions(spark, tmp_path)
    assert found == simulated(batches, lateness=1800)
    assert {row[1] for row in found} == {"ontime", "refire", "drop"}


def test_a_repeated_batch_fires_once(spark, feed, tmp_path, monkeypatch):  # noqa: F811
    """A batch that failed after its emissions were written is run again over the same totals."""
    for times in (["00:10:00"], ["01:00:11"], ["00:59:00", "00:58:00"], ["01:01:00"]):
        feed.add([message(at(time)) for time in times])
    write, calls = refires.write_batch, []

    def failing(frame, path, batch_id, run=None):
        write(frame, path, batch_id, run)
        calls.append((path.rsplit("/", 1)[1], batch_id))
        if calls.count(("totals", 2)) == 1 and calls[-1] == ("totals", 2):
            raise RuntimeError("disk full")

    monkeypatch.setattr(refires, "write_batch", failing)
    with pytest.raises(StreamingQueryException, match="disk full"):
        fire(spark, feed, tmp_path)
    fire(spark, feed, tmp_path)
    assert calls.count(("events", 2)) == 2
    assert [(row[1], row[4]) for row in emissions(spark, tmp_path)] == [("ontime", 1), ("refire", 2), ("refire", 3)]


def test_rejected_lines_move_the_clock_and_count_nowhere(spark, feed, tmp_path):  # noqa: F811
    feed.add([message(at("00:10:00"), 4.0)])
    feed.add([("junk", at("01:00:10")), (None, None)])
    fire(spark, feed, tmp_path)
    assert [row[1:3] + row[4:] for row in emissions(spark, tmp_path)] == [("ontime", 0, 1, 4.0)]


def test_running_totals_of_a_crowded_window(spark, tmp_path):
    """Ties and crowded seconds: every count occurs once, and the sums are those of some order."""
    late = spark.range(0, 5000, 1, 8).select(
        F.lit(3).alias("hour"),
        F.lit(DAY).cast("timestamp").alias("window_start"),
        (F.lit(DAY).cast("timestamp") + F.expr("make_interval(0, 0, 0, 0, 0, 0, id % 700 / 7.0)")).alias("event_time"),
        (F.col("id") % 10).cast("double").alias("fare_amount"),
        F.xxhash64("id").alias("tie"),
    )
    # Stored, so that the plan does not know that there is one window.
    late.write.parquet(str(tmp_path / "late"))
    late = spark.read.parquet(str(tmp_path / "late"))
    rows = running_totals(late).orderBy("trip_count").collect()
    assert [r.trip_count for r in rows] == list(range(1, 5001))
    steps = [b.fare_sum - a.fare_sum for a, b in zip(rows, rows[1:])]
    assert rows[-1].fare_sum == 4.5 * 5000 and set(steps) <= set(map(float, range(10)))
    plan = running_totals(late)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Python" not in plan
