"""The latest hourly rows kept as a table, merged from the change log batch by batch.

``operators.hourly.latest`` reads the whole log each time. Here the batches that have come
since the last merge are joined with the rows they may replace, and only the months they touch are
written again. Months are split by hour of day, so that a reader who wants an hour or a
span of windows opens the files of that hour and those months, and no others.

A merge is a generation: its months lie in its own folder, and a commit, written last,
names them and the log's batches that went in. A reader takes each month from the last
committed generation that has it, so a merge that fails leaves the table as it was,
and its batches go into the next one. ``drop_replaced`` deletes what no reader takes any more.
One merge runs at a time.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.schemas import HOURLY
from meterline.session import delete_path, listed, path_exists
from meterline.sinks.commits import committed_batches
from meterline.sinks.tables import BATCH, RUN, WRITTEN, batch_path, read_table

MONTH = "window_month"
GENERATION = "generation"
#: What decides which of two rows of a group is the later one; a run's batches count anew.
ORDER = (WRITTEN, BATCH, "trip_count")
LOG_BATCH = T.StructType([T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType())])
MERGE = T.StructType(
    [
        T.StructField("months", T.ArrayType(T.StringType()), True),
        T.StructField("batches", T.ArrayType(LOG_BATCH), True),
        T.StructField(GENERATION, T.LongType(), True),
    ]
)
KEPT = T.StructType([*HOURLY.fields, T.StructField(WRITTEN, T.TimestampType()), T.StructField(BATCH, T.LongType())])


def _base(path: str) -> str:
    return f"{path.rstrip('/')}_latest"


def merges(spark: SparkSession, path: str) -> DataFrame:
    """A row per committed generation of the table kept for the log at ``path``."""
    commits = f"{_base(path)}/commits"
    if not path_exists(spark, commits):
        return spark.createDataFrame([], MERGE)
    return spark.read.schema(MERGE).parquet(commits)


def log_batches(spark: SparkSession, path: str) -> set[tuple[str, int]]:
    """The runs and batches of a table, from the names of their folders."""
    found = listed(spark, f"{path.rstrip('/')}/{RUN}=*/{BATCH}=*/_SUCCESS")
    parts = [folder.split("/")[-3:-1] for folder in found]
    return {(run.split("=", 1)[1], int(batch.split("=", 1)[1])) for run, batch in parts}


def current_months(spark: SparkSession, path: str) -> dict[str, int]:
    """The generation that has the current rows of each month; a row per month reaches the driver."""
    months = merges(spark, path).select(F.explode("months").alias(MONTH), GENERATION)
    return {row[MONTH]: row["last"] for row in months.groupBy(MONTH).agg(F.max(GENERATION).alias("last")).collect()}


def _read(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], KEPT)
    rows = spark.read.schema(KEPT).option("basePath", f"{_base(path)}/rows").parquet(*folders)
    return rows.select(KEPT.fieldNames())


def _folders(path: str, current: dict[str, int], months: list[str]) -> list[str]:
    return [f"{_base(path)}/rows/{GENERATION}={current[month]}/{MONTH}={month}" for month in months if month in current]


def newest(changes: DataFrame) -> DataFrame:
    """The last row of each (hour, window) with the columns that decide which is last."""
    rest = [name for name in HOURLY.fieldNames() if name not in ("hour", "window_start", *ORDER)]
    grouped = changes.groupBy("hour", "window_start").agg(F.max(F.struct(*ORDER, *rest)).alias("last"))
    return grouped.select("hour", "window_start", "last.*").select(KEPT.fieldNames())


def _record(spark: SparkSession, path: str, generation: int, months: list[str], batches: list[tuple[str, int]]) -> None:
    row = spark.createDataFrame([(months, batches)], T.StructType(MERGE.fields[:2])).coalesce(1)
    row.write.mode("overwrite").parquet(f"{_base(path)}/commits/{GENERATION}={generation}")


def _months_between(months: list[str], start: datetime | None, end: datetime | None) -> list[str]:
    """The months with windows that start in the span ``[start, end)``."""
    low = f"{start:%Y-%m}" if start else ""
    return [month for month in months if month >= low and (end is None or datetime.strptime(month, "%Y-%m") < end)]


def kept_rows(
    spark: SparkSession,
    path: str,
    hour: int | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """The kept latest rows, of one hour of day or of windows that start in ``[start, end)`` if wanted.

    Only folders of such hours and months are listed and read.
    """
    current = current_months(spark, path)
    folders = _folders(path, current, _months_between(sorted(current), start, end))
    if hour is not None:
        folders = [f"{folder}/hour={hour}" for folder in folders if path_exists(spark, f"{folder}/hour={hour}")]
    rows = _read(spark, path, folders)
    if start is not None:
        rows = rows.filter(F.col("window_start") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        rows = rows.filter(F.col("window_start") < F.lit(end).cast("timestamp_ntz"))
    return rows


def merge_new(spark: SparkSession, path: str, commits: str | None = None) -> int:
    """Merge the log's batches that no generation has; gives their number.

    With ``commits`` only batches that are committed there. The new batches and the kept rows of the
    months they touch are read, nothing else of the log.
    """
    done = {
        (row[RUN], row[BATCH])
        for row in merges(spark, path).select(F.explode("batches").alias("batch")).select("batch.*").collect()
    }
    new = log_batches(spark, path) - done
    if commits is not None:
        new &= {(row[RUN], row[BATCH]) for row in committed_batches(spark, commits).collect()}
    if not new:
        return 0
    log = read_table(spark, path, HOURLY, [batch_path(path, *batch) for batch in sorted(new)])
    months = log.select(F.date_format("window_start", "yyyy-MM").alias(MONTH)).distinct()
    months = sorted(row[MONTH] for row in months.collect())
    last = merges(spark, path).agg(F.max(GENERATION)).first()[0]
    generation = 0 if last is None else last + 1
    kept = _read(spark, path, _folders(path, current_months(spark, path), months))
    merged = newest(log.select(KEPT.fieldNames()).unionByName(kept))
    merged = merged.withColumn(MONTH, F.date_format("window_start", "yyyy-MM"))
    laid = merged.repartition(MONTH, "hour").sortWithinPartitions(MONTH, "hour", "window_start")
    laid.write.mode("overwrite").partitionBy(MONTH, "hour").parquet(f"{_base(path)}/rows/{GENERATION}={generation}")
    _record(spark, path, generation, months, sorted(new))
    return len(new)


def drop_replaced(spark: SparkSession, path: str) -> int:
    """Delete months that a later committed generation has replaced; gives their number.

    Readers that started before the last merge may still need them.
    """
    current = current_months(spark, path)
    dropped = 0
    for folder in listed(spark, f"{_base(path)}/rows/{GENERATION}=*/{MONTH}=*"):
        generation, month = (part.split("=", 1)[1] for part in folder.rstrip("/").split("/")[-2:])
        if month in current and int(generation) < current[month]:
            dropped += delete_path(spark, folder)
    return dropped
