"""Parquet tables: a partition per run and micro-batch, laid out for time filters.

A run is a streaming query with its checkpoint. Batch numbers start at 0 in each run,
so a batch replaces itself and never one of another run on the same table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.schemas import DECODED, HOURLY, TRIP

RUN = "run_id"
BATCH = "batch_id"
DAY = "pickup_date"
MONTH = "pickup_month"
#: When an aggregate row was written; it keeps rising over batches and runs.
WRITTEN = "written_at"
AUDIT_COLUMNS = ("id", "created_at", WRITTEN, RUN, BATCH, DAY, MONTH)
#: The run of batches that no streaming query writes.
NO_QUERY = "direct"
QUERY_ID = "sql.streaming.queryId"

# Target table names and their columns.
TABLES: dict[str, T.StructType] = {
    "taxi_trips": TRIP,
    "yellow_taxi_stream": DECODED,
    "hourly_aggregates": HOURLY,
}


def with_audit(frame: DataFrame, row_id: bool = False, created_at: bool = False) -> DataFrame:
    """Optional surrogate key (unique within a batch, not dense) and write time."""
    if row_id:
        frame = frame.withColumn("id", F.monotonically_increasing_id())
    if created_at:
        frame = frame.withColumn("created_at", F.current_timestamp())
    return frame


def by_day(frame: DataFrame, rebalance: bool = True) -> DataFrame:
    """Rows sorted by pickup within each task, with the day column to partition by.

    ``rebalance`` groups the days by a shuffle, so that a day gets a file and not
    one per task; adaptive execution cuts a day that is too large for one task.
    Without it, for trips that come in time order, there is no shuffle.
    """
    dated = frame.withColumn(DAY, F.col("pickup_datetime").cast("date"))
    if rebalance:
        dated = dated.hint("rebalance", DAY)
    return dated.sortWithinPartitions(DAY, "pickup_datetime")


def by_month(frame: DataFrame, rebalance: bool = True) -> DataFrame:
    """The same with a folder per month, for batches of many days with few rows each.

    The day stays a column of the files, in order, so that a filter on it skips row groups.
    """
    day = F.col("pickup_datetime").cast("date")
    dated = frame.withColumns({DAY: day, MONTH: F.trunc(day, "month")})
    if rebalance:
        dated = dated.hint("rebalance", MONTH)
    return dated.sortWithinPartitions(MONTH, "pickup_datetime")


def run_of(frame: DataFrame) -> str:
    """The id of the streaming query that hands over this batch, as its checkpoint keeps it."""
    return frame.sparkSession.sparkContext.getLocalProperty(QUERY_ID) or NO_QUERY


def batch_path(path: str, run: str, batch_id: int) -> str:
    """The partition of a run's batch."""
    return f"{path.rstrip('/')}/{RUN}={run}/{BATCH}={batch_id}"


def write_batch(frame: DataFrame, path: str, batch_id: int, run: str | None = None) -> None:
    """One micro-batch of a run as its own partition. Writing it again replaces it.

    Trip rows are split further by day, or by month. Outside of a streaming query, name
    the ``run`` if several write to the table.
    """
    target = batch_path(path, run or run_of(frame), batch_id)
    folders = [name for name in (MONTH, DAY) if name in frame.columns][:1]
    frame.write.mode("overwrite").partitionBy(*folders).parquet(target)


def trip_sink(
    path: str,
    row_id: bool = False,
    created_at: bool = False,
    rebalance: bool = True,
    months: bool = False,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for raw or decoded trips, by day or in ``months``.

    All batches of a table are laid out alike.
    """
    laid_out = by_month if months else by_day

    def write(frame: DataFrame, batch_id: int) -> None:
        write_batch(laid_out(with_audit(frame, row_id, created_at), rebalance), path, batch_id)

    return write


def hourly_sink(
    path: str, row_id: bool = False, created_at: bool = False
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for hourly aggregates, kept as an append-only log.

    The rows of a batch, at most one per hour of day and open window, are gathered
    into a file, or several should they be many.
    """

    def write(frame: DataFrame, batch_id: int) -> None:
        compact = frame.hint("rebalance").sortWithinPartitions("window_start", "hour")
        stamped = with_audit(compact, row_id, created_at).withColumn(WRITTEN, F.current_timestamp())
        write_batch(stamped, path, batch_id)

    return write


def reject_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for rejected lines, in few files."""

    def write(frame: DataFrame, batch_id: int) -> None:
        write_batch(frame.hint("rebalance"), path, batch_id)

    return write


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, within: list[str] | None = None
) -> DataFrame:
    """The table's own columns plus its partition columns, and when aggregates were written.

    Trips have their day either way, those laid out by month their month as well.
    ``within`` names the folders or files of the table to read, if not all.
    """
    parts = [T.StructField(RUN, T.StringType(), True), T.StructField(BATCH, T.LongType(), True)]
    if "pickup_datetime" in schema.fieldNames():
        parts.append(T.StructField(DAY, T.DateType(), True))
    else:
        parts.insert(0, T.StructField(WRITTEN, T.TimestampType(), True))
    reader = spark.read.schema(T.StructType([*schema.fields, *parts]))
    return reader.parquet(path) if within is None else reader.option("basePath", path).parquet(*within)


def replace_table(frame: DataFrame, path: str) -> None:
    """The whole table from one frame; what was there before is gone."""
    frame.write.mode("overwrite").parquet(path)


def create_tables(spark: SparkSession, root: str, database: str | None = None) -> None:
    """Catalog entries for the three target tables below ``root``, laid out by day, where missing.

    A failure is raised to the caller.
    """
    for name, schema in TABLES.items():
        full = f"{database}.{name}" if database else name
        days = ", " + DAY if "pickup_datetime" in schema.fieldNames() else ""
        extra = "" if days else f", {WRITTEN} TIMESTAMP"
        extra += f", {RUN} STRING, {BATCH} BIGINT" + (f", {DAY} DATE" if days else "")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {full} ({schema.toDDL()}{extra}) USING parquet "
            f"PARTITIONED BY ({RUN}, {BATCH}{days}) LOCATION '{root.rstrip('/')}/{name}'"
        )


def refresh_table(spark: SparkSession, name: str) -> None:
    """Make the batches written since the last call visible to the catalog entry."""
    spark.catalog.recoverPartitions(name)
