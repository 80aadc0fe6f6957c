"""One stream of lines to all tables: raw, decoded, rejected, hourly and dropped."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterline.operators.decode import decode
from meterline.operators.parse import classify, rejects, trips, watch_reasons
from meterline.operators.window_apply import WindowFunction
from meterline.schemas import TRIP
from meterline.session import ROCKSDB, stream_settings
from meterline.sinks.commits import together
from meterline.sinks.jdbc import (
    DECODED_TRIPS,
    HOURLY_FARES,
    RAW,
    jdbc_sink,
    refuse_wide_flags,
)
from meterline.sinks.tables import hourly_sink, reject_sink, trip_sink
from meterline.streaming.applied import apply_window_stream
from meterline.streaming.clock import DISORDER_SECONDS, LATENESS_SECONDS
from meterline.streaming.hourly import STATE_PARTITIONS, checkpointed, hourly_updates
from meterline.streaming.lateness import late_hourly
from meterline.streaming.moved import MovedState
from meterline.streaming.progress import watch_windows
from meterline.streaming.refires import refire_sink

Sink = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class Outputs:
    """Where each branch goes: a ``foreachBatch`` function per table.

    ``narrow_flags`` rejects trips whose flag is too wide for a database column. With a
    commit table in ``commits`` the tables of a batch appear together (``sinks.commits``).
    """

    raw: Sink
    decoded: Sink
    rejected: Sink
    hourly: Sink
    dropped: Sink
    narrow_flags: bool = False
    commits: str | None = None

    @classmethod
    def below(
        cls, root: str, rebalance: bool = True, commits: bool = False, months: bool = False
    ) -> Outputs:
        """Parquet tables in folders below ``root``; ``rebalance`` gives the days few files.

        ``commits`` keeps a commit table there, for ``read_committed``. ``months`` lays the
        trips out by month, not by day, for batches that span hundreds of days.
        """
        root = root.rstrip("/")
        return cls(
            raw=trip_sink(f"{root}/taxi_trips", rebalance=rebalance, months=months),
            decoded=trip_sink(f"{root}/yellow_taxi_stream", rebalance=rebalance, months=months),
            rejected=reject_sink(f"{root}/rejects"),
            hourly=hourly_sink(f"{root}/hourly_aggregates"),
            dropped=hourly_sink(f"{root}/late_drops"),
            commits=f"{root}/commits" if commits else None,
        )

    @classmethod
    def database(cls, url: str, root: str, **options) -> Outputs:
        """The three target tables of a database; rejects and drops as files below ``root``."""
        root = root.rstrip("/")
        return cls(
            raw=jdbc_sink(RAW, url, **options),
            decoded=jdbc_sink(DECODED_TRIPS, url, **options),
            rejected=reject_sink(f"{root}/rejects"),
            hourly=jdbc_sink(HOURLY_FARES, url, **options),
            dropped=hourly_sink(f"{root}/late_drops"),
            narrow_flags=True,
        )


def start_trips(
    lines: DataFrame,
    outputs: Outputs,
    checkpoint: str,
    interval: str | None = "60 seconds",
    name: str = "trips",
    watch: bool = False,
) -> StreamingQuery:
    """Raw, decoded and rejected rows; late rows included, as no watermark applies.

    The batch is parsed once and kept for the three writes, the text of good lines
    left out. Bound the batches of the source, or the first one is the whole backlog.
    With ``watch`` the query reports its lines by reason (``streaming.progress``).
    """

    def fan_out(batch: DataFrame, batch_id: int) -> None:
        parsed = batch if watch else classify(batch)
        if outputs.narrow_flags:
            parsed = refuse_wide_flags(parsed)
        parsed = parsed.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))
        parsed.persist()
        try:
            good = trips(parsed).select(*TRIP.fieldNames())
            outputs.raw(good, batch_id)
            outputs.decoded(decode(good), batch_id)
            outputs.rejected(rejects(parsed), batch_id)
        finally:
            parsed.unpersist()

    rows = watch_reasons(classify(lines), "lines") if watch else lines
    writer = rows.writeStream.foreachBatch(together(outputs.commits, fan_out))
    return checkpointed(writer, name, checkpoint, interval).start()


def start_hourly(
    lines: DataFrame,
    sink: Sink,
    checkpoint: str,
    event_time: str = "timestamp",
    interval: str | None = "60 seconds",
    state_partitions: int = STATE_PARTITIONS,
    name: str = "hourly-fares",
) -> StreamingQuery:
    """Running hourly rows from the first trip of a window on; read them through ``latest``.

    Spark compares a row with the watermark of the batch before, so a row that
    comes just one batch too late may still count here.
    """
    updates = hourly_updates(lines, event_time)
    writer = updates.writeStream.outputMode("update").foreachBatch(sink)
    # A batch without rows would only clear old state, which the next batch does too.
    with stream_settings(
        lines.sparkSession,
        spark__sql__shuffle__partitions=str(state_partitions),
        spark__sql__streaming__noDataMicroBatches__enabled="false",
    ):
        return checkpointed(writer, name, checkpoint, interval).start()


def start_late_hourly(
    lines: DataFrame,
    sink: Sink,
    checkpoint: str,
    event_time: str = "timestamp",
    interval: str | None = "60 seconds",
    disorder_seconds: int = DISORDER_SECONDS,
    lateness_seconds: int = LATENESS_SECONDS,
    state_partitions: int = STATE_PARTITIONS,
    name: str = "late-hourly-fares",
    watch: bool = False,
    moved: MovedState | None = None,
) -> StreamingQuery:
    """Hourly rows as they fire: on time, again for late rows, and drops.

    The watermark follows the newest row of all partitions. Where one may lag behind
    the others, by several topic partitions or a backlog read in bounded batches, set
    ``disorder_seconds`` to the longest lag, or its rows come as drops. With ``watch``
    the query reports its emissions by kind (``streaming.progress``). ``moved`` is the
    state of a stopped query whose input ``lines`` go on with (``streaming.moved``).
    """
    events = late_hourly(lines, event_time, disorder_seconds, lateness_seconds, moved=moved)
    if watch:
        events = watch_windows(events)
    writer = events.writeStream.outputMode("update").foreachBatch(sink)
    with stream_settings(
        lines.sparkSession,
        spark__sql__shuffle__partitions=str(state_partitions),
        spark__sql__streaming__stateStore__providerClass=ROCKSDB,
    ):
        return checkpointed(writer, name, checkpoint, interval).start()


def start_refires(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    event_time: str = "timestamp",
    interval: str | None = "60 seconds",
    disorder_seconds: int = DISORDER_SECONDS,
    lateness_seconds: int = LATENESS_SECONDS,
    name: str = "refired-fares",
) -> StreamingQuery:
    """Hourly rows to the table at ``path``, one for every late row; open totals lie in the checkpoint folder."""
    sink = refire_sink(path, f"{checkpoint}/open-windows", event_time, disorder_seconds, lateness_seconds)
    return checkpointed(lines.writeStream.foreachBatch(sink), name, checkpoint, interval).start()


def start_applied(
    lines: DataFrame,
    function: WindowFunction,
    sink: Sink,
    checkpoint: str,
    event_time: str = "timestamp",
    interval: str | None = "60 seconds",
    disorder_seconds: int = DISORDER_SECONDS,
    lateness_seconds: int = LATENESS_SECONDS,
    state_partitions: int = STATE_PARTITIONS,
    name: str = "applied-window",
) -> StreamingQuery:
    """A caller's window function over the stream, with the emissions of ``start_late_hourly``."""
    events = apply_window_stream(lines, function, event_time, disorder_seconds, lateness_seconds)
    writer = events.writeStream.outputMode("update").foreachBatch(sink)
    with stream_settings(
        lines.sparkSession,
        spark__sql__shuffle__partitions=str(state_partitions),
        spark__sql__streaming__stateStore__providerClass=ROCKSDB,
    ):
        return checkpointed(writer, name, checkpoint, interval).start()


def fired_sink(hourly: Sink, dropped: Sink) -> Sink:
    """Fired rows to the hourly table, counts of rows that came too late to another.

    The emissions of a batch are a few rows, kept while both are written.
    """

    def write(events: DataFrame, batch_id: int) -> None:
        held = events.persist()
        try:
            late = F.col("kind") == "drop"
            hourly(held.filter(~late).drop("kind"), batch_id)
            dropped(held.filter(late).drop("kind"), batch_id)
        finally:
            held.unpersist()

    return write


def start_pipeline(
    lines: DataFrame,
    outputs: Outputs,
    checkpoint: str,
    event_time: str = "timestamp",
    interval: str | None = "60 seconds",
    disorder_seconds: int = DISORDER_SECONDS,
    lateness_seconds: int = LATENESS_SECONDS,
    state_partitions: int = STATE_PARTITIONS,
    prefix: str = "",
) -> list[StreamingQuery]:
    """All branches on one input, each query with its own checkpoint folder.

    The hourly table gets a window when it fires and again when allowed late
    rows change it; for running rows start ``start_hourly`` instead. ``prefix``
    tells the queries of several pipelines in a session apart.
    """
    sink = together(outputs.commits, fired_sink(outputs.hourly, outputs.dropped))
    trips_query = start_trips(
        lines, outputs, f"{checkpoint}/trips", interval, name=f"{prefix}trips"
    )
    try:
        hourly_query = start_late_hourly(
            lines,
            sink,
            f"{checkpoint}/hourly",
            event_time,
            interval,
            disorder_seconds,
            lateness_seconds,
            state_partitions,
            name=f"{prefix}late-hourly-fares",
        )
    except Exception:
        trips_query.stop()
        raise
    return [trips_query, hourly_query]


def await_all(queries: list[StreamingQuery], poll_seconds: float = 1.0) -> None:
    """Wait for all queries of a pipeline; when one fails, stop the others and raise."""
    try:
        waiting = list(queries)
        while waiting:
            waiting = [query for query in waiting if not query.awaitTermination(poll_seconds)]
    except Exception:
        for query in queries:
            query.stop()
        raise
