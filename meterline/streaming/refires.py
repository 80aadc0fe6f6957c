"""Hourly windows that fire again for every single late row.

``streaming.lateness`` reports a window once per batch of late rows. Here each late row
brings out a row of its own: the mean and count of all that came before it and of itself, in the
order of batches and, within one, of event time.

The stream itself holds nothing. Each micro-batch is a job of built-in functions: it reads the
running totals of open windows that the batch before has left, fires and drops by the
watermark that the batches before have reached, and leaves the totals that are still open
behind, with the newest event time. What a batch writes lies in its own partition and comes from
its rows and the partition before, so a batch that is repeated writes the same again.

Running totals over late rows are taken in two steps, so that no task holds a crowded
window: rows are added up by window and second, the sums of the seconds are run through in order,
and the rows of a second start from there.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions.clock import hour_of_day
from meterline.operators.parse import classify
from meterline.session import delete_path, path_exists, require_utc
from meterline.sinks.tables import batch_path, run_of, write_batch
from meterline.streaming.clock import DISORDER_SECONDS, LATENESS_SECONDS, WINDOW_SECONDS

GROUP = ["hour", "window_start"]
TOTALS = T.StructType(
    [
        T.StructField("hour", T.IntegerType(), True),
        T.StructField("window_start", T.TimestampType(), True),
        T.StructField("fare_sum", T.DoubleType(), True),
        T.StructField("trip_count", T.LongType(), True),
    ]
)
CLOCK = T.StructType([T.StructField("newest", T.TimestampType(), True)])
SIZE = f"INTERVAL {WINDOW_SECONDS} SECONDS"


def running_totals(late: DataFrame) -> DataFrame:
    """Late rows with ``fare_sum`` and ``trip_count`` of their window's late rows up to and with each."""
    timed = late.withColumn("second", F.date_trunc("second", "event_time"))
    seconds = timed.groupBy(*GROUP, "second").agg(F.sum("fare_amount").alias("sum"), F.count("*").alias("count"))
    before = Window.partitionBy(*GROUP).orderBy("second").rowsBetween(Window.unboundedPreceding, -1)
    starts = seconds.select(
        *GROUP,
        "second",
        F.coalesce(F.sum("sum").over(before), F.lit(0.0)).alias("sum_before"),
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("count_before"),
    )
    so_far = Window.partitionBy(*GROUP, "second").orderBy("event_time", "fare_amount", "tie")
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return timed.join(starts, [*GROUP, "second"]).select(
        *GROUP,
        (F.col("sum_before") + F.sum("fare_amount").over(so_far)).alias("fare_sum"),
        (F.col("count_before") + F.count("*").over(so_far)).alias("trip_count"),
    )


def _added(*parts: DataFrame) -> DataFrame:
    """Totals of the same windows as one."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy(*GROUP).agg(F.sum("fare_sum").alias("fare_sum"), F.sum("trip_count").alias("trip_count"))


def _emission(totals: DataFrame, kind: str) -> DataFrame:
    start = F.col("window_start")
    return totals.select(
        "hour",
        start.cast("timestamp_ntz").alias("window_start"),
        (start + F.expr(SIZE)).cast("timestamp_ntz").alias("window_end"),
        (F.col("fare_sum") / F.col("trip_count")).alias("average_fare"),
        "trip_count",
        F.lit(kind).alias("kind"),
    )


def _left(spark: SparkSession, state: str, run: str, batch_id: int) -> tuple[DataFrame, datetime | None]:
    """What a batch has left: the totals of open windows, and the newest event time."""
    totals, clock = (batch_path(f"{state}/{part}", run, batch_id) for part in ("totals", "clock"))
    if not path_exists(spark, clock):
        return spark.createDataFrame([], TOTALS), None
    return spark.read.schema(TOTALS).parquet(totals), spark.read.schema(CLOCK).parquet(clock).first()["newest"]


def _literal(moment: datetime) -> Column:
    return F.lit(f"{moment:%Y-%m-%d %H:%M:%S.%f}").cast("timestamp")


def refire_sink(
    path: str,
    state: str,
    event_time: str = "timestamp",
    disorder_seconds: int = DISORDER_SECONDS,
    lateness_seconds: int = LATENESS_SECONDS,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for message lines: emissions to ``path``, open totals below ``state``.

    Rows are ``ontime``, ``refire`` and ``drop`` as in ``streaming.lateness``. Rejected lines
    move the clock like any other message when ``event_time`` is a column of the lines.
    """
    lateness = F.expr(f"INTERVAL {lateness_seconds} SECONDS")
    disorder = timedelta(seconds=disorder_seconds)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, run_of(batch)
        require_utc(spark)
        parsed = classify(batch).select(
            "reason",
            hour_of_day(F.col("pickup_datetime")).alias("hour"),
            F.col(event_time).cast("timestamp").alias("event_time"),
            "fare_amount",
            F.xxhash64("value").alias("tie"),
        )
        rows = parsed.withColumn("window_start", F.window("event_time", f"{WINDOW_SECONDS} seconds")["start"]).persist()
        try:
            before, newest = _left(spark, state, run, batch_id - 1)
            seen = rows.agg(F.max("event_time").alias("newest"))
            latest = max((moment for moment in (newest, seen.first()["newest"]) if moment), default=None)
            end = F.col("window_start") + F.expr(SIZE)
            mark = _literal(newest - disorder) if newest else F.lit(None).cast("timestamp")
            due, gone = (F.coalesce(mark >= limit, F.lit(False)) for limit in (end, end + lateness))
            good = rows.filter(F.col("reason").isNull() & F.col("event_time").isNotNull())
            totals = [F.sum("fare_amount").alias("fare_sum"), F.count("*").alias("trip_count")]
            dropped = good.filter(gone).groupBy(*GROUP).agg(*totals)
            kept = good.filter(~gone)
            running = running_totals(kept.filter(due))
            base = before.select(*GROUP, F.col("fare_sum").alias("base_sum"), F.col("trip_count").alias("base_count"))
            refired = running.join(base, GROUP, "left").select(
                *GROUP,
                (F.col("fare_sum") + F.coalesce("base_sum", F.lit(0.0))).alias("fare_sum"),
                (F.col("trip_count") + F.coalesce("base_count", F.lit(0))).alias("trip_count"),
            )
            now = _added(before, kept.groupBy(*GROUP).agg(*totals))
            after = _literal(latest - disorder) if latest else F.lit(None).cast("timestamp")
            fires = F.coalesce(after >= end, F.lit(False)) & ~due
            events = _emission(now.filter(fires), "ontime")
            events = events.unionByName(_emission(refired, "refire")).unionByName(_emission(dropped, "drop"))
            write_batch(events.hint("rebalance"), path, batch_id, run)
            still = now.filter(~F.coalesce(after >= end + lateness, F.lit(False)))
            write_batch(still.select(TOTALS.names).hint("rebalance"), f"{state}/totals", batch_id, run)
            # The newest time comes last: it says that the totals are complete.
            clock = spark.range(1, numPartitions=1).select((_literal(latest) if latest else F.lit(None).cast("timestamp")).alias("newest"))
            write_batch(clock, f"{state}/clock", batch_id, run)
            for part in ("totals", "clock"):
                # Only the batch before can be asked for again.
                delete_path(spark, batch_path(f"{state}/{part}", run, batch_id - 2))
        finally:
            rows.unpersist()

    return write
