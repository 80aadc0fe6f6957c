"""Batches whose tables appear together or not at all.

The rows of a micro-batch go to several tables, each to the partition of its run and
batch. When all are written, one row for the batch is written to a commit table, last.
Readers join the commit table, so what a failed batch left behind is never seen; the
batch, run again, replaces it. A batch that is committed already is not written again:
Spark repeats a batch with the same offsets, so the rows would be the same, and
readers never see a table without them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.session import path_exists
from meterline.sinks.tables import BATCH, RUN, batch_path, read_table, run_of

COMMIT = T.StructType(
    [
        T.StructField("committed_at", T.TimestampType(), True),
        T.StructField(RUN, T.StringType(), True),
        T.StructField(BATCH, T.LongType(), True),
    ]
)


def is_committed(spark: SparkSession, commits: str, batch_id: int, run: str) -> bool:
    """Whether the batch's commit is complete; Spark adds the marker asked for when a write is done."""
    return path_exists(spark, f"{batch_path(commits, run, batch_id)}/_SUCCESS")


def commit(spark: SparkSession, commits: str, batch_id: int, run: str) -> None:
    row = spark.range(1, numPartitions=1).select(F.current_timestamp().alias("committed_at"))
    row.write.mode("overwrite").parquet(batch_path(commits, run, batch_id))


def together(commits: str | None, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that commits what ``write`` wrote; without ``commits`` it is ``write``."""
    if commits is None:
        return write

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, run_of(batch)
        if not is_committed(spark, commits, batch_id, name):
            write(batch, batch_id)
            commit(spark, commits, batch_id, name)

    return run


def committed_batches(spark: SparkSession, commits: str) -> DataFrame:
    """A row per committed batch; none before the first one."""
    if not path_exists(spark, commits):
        return spark.createDataFrame([], COMMIT)
    return spark.read.schema(COMMIT).parquet(commits)


def only_committed(rows: DataFrame, commits: str) -> DataFrame:
    """Rows with run and batch columns whose batch is committed."""
    batches = committed_batches(rows.sparkSession, commits).select(RUN, BATCH)
    return rows.join(batches, [RUN, BATCH], "left_semi").select(rows.columns)


def read_committed(spark: SparkSession, path: str, schema: T.StructType, commits: str) -> DataFrame:
    """A table as ``read_table`` gives it, without batches that are not committed."""
    return only_committed(read_table(spark, path, schema), commits)
