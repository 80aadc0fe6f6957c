"""What streams report about themselves, kept as a table: rows, rates, watermark, drops, counters.

A query's batches come as events to the driver, one small row each. They are held and
written together: every ``hold`` rows, when a query ends, and on ``flush``. Counters are what the plans
observe: ``watch_reasons`` on classified lines, ``watch_windows`` on emissions.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from meterline.session import path_exists

PROGRESS = T.StructType(
    [
        T.StructField("query_name", T.StringType(), True),
        T.StructField("query_id", T.StringType(), True),
        T.StructField("start_id", T.StringType(), True),
        T.StructField("batch_id", T.LongType(), True),
        T.StructField("started_at", T.StringType(), True),
        T.StructField("input_rows", T.LongType(), True),
        T.StructField("input_rows_per_second", T.DoubleType(), True),
        T.StructField("processed_rows_per_second", T.DoubleType(), True),
        T.StructField("batch_millis", T.LongType(), True),
        T.StructField("watermark", T.StringType(), True),
        T.StructField("late_rows_dropped", T.LongType(), True),
        T.StructField("state_rows", T.LongType(), True),
        T.StructField("state_bytes", T.LongType(), True),
        T.StructField("counters", T.MapType(T.StringType(), T.LongType()), True),
    ]
)
HOLD = 100


def watch_windows(events: DataFrame, watch: str = "windows") -> DataFrame:
    """Emissions whose query reports how many there were of each kind, and the trips dropped."""
    kind = F.col("kind")
    return events.observe(
        watch,
        F.count_if(kind == "ontime").alias("ontime"),
        F.count_if(kind == "refire").alias("refire"),
        F.coalesce(F.sum(F.when(kind == "drop", F.col("trip_count"))), F.lit(0)).alias("dropped_trips"),
    )


class ProgressTable(StreamingQueryListener):
    """A listener that appends a row per batch of every query of the session to ``path``."""

    def __init__(self, spark: SparkSession, path: str, hold: int = HOLD) -> None:
        self.spark, self.path, self.hold = spark, path, hold
        self.held: list[tuple] = []
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counters = {
            name: int(count)
            for row in progress.observedMetrics.values()
            for name, count in row.asDict().items()
            if count is not None
        }
        states = progress.stateOperators
        row = (
            progress.name,
            str(progress.id),
            str(progress.runId),
            progress.batchId,
            progress.timestamp,
            progress.numInputRows,
            progress.inputRowsPerSecond,
            progress.processedRowsPerSecond,
            progress.durationMs.get("triggerExecution"),
            progress.eventTime.get("watermark"),
            sum(state.numRowsDroppedByWatermark for state in states),
            sum(state.numRowsTotal for state in states),
            sum(state.memoryUsedBytes for state in states),
            counters,
        )
        with self.lock:
            self.held.append(row)
            full = len(self.held) >= self.hold
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        """Write what is held, as a file of its own."""
        with self.lock:
            rows, self.held = self.held, []
        if rows:
            frame = self.spark.createDataFrame(rows, PROGRESS).coalesce(1)
            frame.write.parquet(f"{self.path.rstrip('/')}/part={uuid.uuid4().hex}")


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The last report of each batch; a batch that was repeated has several."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], PROGRESS)
    rows = spark.read.schema(PROGRESS).parquet(path)
    rest = [name for name in PROGRESS.names if name not in ("query_id", "batch_id", "started_at")]
    last = rows.groupBy("query_id", "batch_id").agg(F.max_by(F.struct("started_at", *rest), "started_at").alias("last"))
    return last.select("query_id", "batch_id", "last.*").select(PROGRESS.names)


def counted(progress: DataFrame) -> DataFrame:
    """Each counter's sum over a query's batches."""
    each = progress.select("query_name", F.explode("counters").alias("counter", "count"))
    return each.groupBy("query_name", "counter").agg(F.sum("count").alias("total"))
