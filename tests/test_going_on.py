"""Streams that go on: with more state partitions, after a failed replay; and what they report."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.errors import StreamingQueryException

from meterline.operators.parse import parse_trips
from meterline.operators.publish import publish_lines
from meterline.plans.pipeline import start_late_hourly
from meterline.plans.tables import start_replay
from meterline.schemas import LINE_FIELDS
from meterline.sinks.tables import write_batch
from meterline.sinks.topic import line_batches
from meterline.streaming.moved import moved_state, open_windows, watermark_of
from meterline.streaming.progress import PROGRESS, ProgressTable, counted, read_progress
from test_streaming import DAY, Feed, at, feed, message  # noqa: F401

# Moved state.

BEFORE = (["00:10:00", "00:50:00", "01:30:00"], ["02:00:30"], ["01:20:00"])
# Late for a window that has fired, too late for one that is gone, and the clock going on.
AFTER = (["01:40:00", "00:20:00"], ["01:45:00", "02:10:00"], ["03:10:00"], ["04:00:00"])


def run(spark, feed, table, state, **settings):  # noqa: F811
    start_late_hourly(
        feed.stream(), lambda frame, batch: write_batch(frame, table, batch), state, interval=None, **settings
    ).awaitTermination()


def emissions(spark, table):
    names = ("kind", "hour", "window_start", "trip_count", "average_fare")
    return sorted(tuple(row[name] for name in names) for row in spark.read.parquet(table).collect())


def test_a_query_goes_on_with_fewer_partitions(spark, tmp_path):
    whole, old, new = (Feed(spark, tmp_path / name) for name in ("whole", "old", "new"))
    for number, times in enumerate((*BEFORE, *AFTER)):
        messages = [message(at(time), fare=float(number + i)) for i, time in enumerate(times)]
        whole.add(messages)
        (old if number < len(BEFORE) else new).add(messages)
    expected, found = str(tmp_path / "expected"), str(tmp_path / "found")
    run(spark, whole, expected, str(tmp_path / "whole-state"))
    run(spark, old, found, str(tmp_path / "old-state"), state_partitions=5)
    moved = moved_state(spark, str(tmp_path / "old-state"))
    run(spark, new, found, str(tmp_path / "new-state"), state_partitions=3, moved=moved)
    assert emissions(spark, found) == emissions(spark, expected)
    assert {row[0] for row in emissions(spark, found)} == {"ontime", "refire", "drop"}


def test_open_windows_of_a_checkpoint(spark, feed, tmp_path):  # noqa: F811
    state = str(tmp_path / "state")
    for times in BEFORE:
        feed.add([message(at(time), fare=2.0) for time in times])
    run(spark, feed, str(tmp_path / "events"), state)
    rows = {(r.hour, r.trip_count, r.average_fare, r.fired) for r in open_windows(spark, state).collect()}
    assert rows == {(1, 2, 2.0, True), (2, 1, 2.0, False)}
    assert watermark_of(spark, state) == int((at("02:00:20") - DAY).total_seconds() * 1000) + 1735689600000


# Replays.


def table_of(spark, tmp_path, lines):
    trips = parse_trips(spark.createDataFrame(lines, "value string, timestamp timestamp")).select(LINE_FIELDS.names)
    trips.repartition(6).write.mode("append").parquet(str(tmp_path / "table"))
    return str(tmp_path / "table")


def test_a_replay_goes_on_where_it_failed(spark, tmp_path):
    path = table_of(spark, tmp_path, [message(at(f"00:10:{second:02}"), float(second)) for second in range(30)])
    write, calls = line_batches(str(tmp_path / "lines")), []

    def failing(lines, batch_id):
        write(lines, batch_id)
        calls.append(batch_id)
        if calls == [0, 1]:
            raise RuntimeError("gone")

    def replay():
        start_replay(spark, path, LINE_FIELDS, failing, str(tmp_path / "state"), files_per_batch=2).awaitTermination()

    with pytest.raises(StreamingQueryException, match="gone"):
        replay()
    replay()
    assert calls == [0, 1, 1, 2]

    def published():
        return sorted(row.value for row in spark.read.text(str(tmp_path / "lines")).select("value").collect())

    assert published() == sorted(r.value for r in publish_lines(spark.read.parquet(path)).collect())
    table_of(spark, tmp_path, [message(at("00:11:00"), 99.0)])
    replay()
    assert len(published()) == 31


# Progress.


def event(batch, counters=None, name="q", dropped=0, started="2025-01-01T00:00:00.000Z"):
    state = SimpleNamespace(numRowsDroppedByWatermark=dropped, numRowsTotal=7, memoryUsedBytes=100)
    observed = {"lines": SimpleNamespace(asDict=lambda: counters)} if counters else {}
    progress = SimpleNamespace(
        name=name, id="id-" + name, runId="run", batchId=batch, timestamp=started, numInputRows=5, inputRowsPerSecond=1.0,
        processedRowsPerSecond=2.0, durationMs={"triggerExecution": 30}, eventTime={"watermark": "w"},
        stateOperators=[state, state], observedMetrics=observed,
    )
    return SimpleNamespace(progress=progress)


def test_progress_is_held_and_written_together(spark, tmp_path):
    path = str(tmp_path / "progress")
    table = ProgressTable(spark, path, hold=2)
    assert read_progress(spark, path).count() == 0
    table.onQueryProgress(event(0, {"lines": 5, "blank": None}))
    assert read_progress(spark, path).count() == 0
    table.onQueryProgress(event(1, {"lines": 6, "blank": 2}, dropped=3))
    assert read_progress(spark, path).count() == 2
    # The batch is repeated: only its last report counts.
    table.onQueryProgress(event(1, {"lines": 8, "blank": 1}, dropped=3, started="2025-01-01T00:01:00.000Z"))
    table.onQueryTerminated(None)
    rows = {row.batch_id: row for row in read_progress(spark, path).collect()}
    assert read_progress(spark, path).schema == PROGRESS and len(rows) == 2
    assert rows[1].late_rows_dropped == 6 and rows[1].state_rows == 14 and rows[1].batch_millis == 30
    totals = {(row.query_name, row.counter): row.total for row in counted(read_progress(spark, path)).collect()}
    assert totals == {("q", "lines"): 13, ("q", "blank"): 1}
    table.flush()
    assert read_progress(spark, path).count() == 2
