"""Surrogate keys 1..n over a whole table, without gaps, across batches and runs.

A batch is laid down once with its tasks' row numbers. The rows of each task are counted;
running sums of the counts, added to the number of keys the table has given out so far, are the
tasks' first keys. No sort and no task that sees all rows: the only thing collected is a
count per task.

The table's ledger has a row per run and batch: its first key and its number of rows. It
is written before the keyed rows are. A batch that is run again finds its row and gets the
same keys; one whose row count has changed meanwhile is refused unless it was the last.
Queries that write at the same time cannot share a table with such keys.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.operators.publish import NUMBER_BITS
from meterline.session import path_exists
from meterline.sinks.tables import BATCH, RUN, batch_path, run_of

LEDGER = T.StructType(
    [
        T.StructField("first_id", T.LongType(), True),
        T.StructField("row_count", T.LongType(), True),
        T.StructField(RUN, T.StringType(), True),
        T.StructField(BATCH, T.LongType(), True),
    ]
)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """First key and number of rows of each batch of the table at ``path``."""
    ids = f"{path.rstrip('/')}_ids"
    if not path_exists(spark, ids):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ids)


def claimed(spark: SparkSession, path: str, batch_id: int, run: str, rows: int) -> int:
    """The first key of a batch of so many rows; the claim is on record when this returns."""
    own = (F.col(RUN) == run) & (F.col(BATCH) == batch_id)
    given = ledger(spark, path).agg(
        F.max(F.when(own, F.col("first_id"))).alias("first"),
        F.max(F.when(own, F.col("row_count"))).alias("count"),
        F.max(F.when(~own, F.col("first_id") + F.col("row_count") - 1)).alias("others"),
    )
    given = given.first()
    others = given["others"] or 0
    if given["first"] is not None:
        if given["count"] == rows:
            return given["first"]
        if given["first"] <= others:
            raise ValueError(f"batch {batch_id} of run {run} had {given['count']} rows and now has {rows}; later keys are taken")
    row = spark.createDataFrame([(others + 1, rows)], "first_id LONG, row_count LONG").coalesce(1)
    row.write.mode("overwrite").parquet(batch_path(f"{path.rstrip('/')}_ids", run, batch_id))
    return others + 1


def with_dense_ids(frame: DataFrame, path: str, batch_id: int, run: str | None = None, name: str = "id") -> DataFrame:
    """The batch with its keys in ``name``; it is read from a staging folder beside the table.

    The staged batch is replaced when the batch is run again.
    """
    spark, run = frame.sparkSession, run or run_of(frame)
    staged = batch_path(f"{path.rstrip('/')}_staged", run, batch_id)
    at = "_at" if name != "_at" else "_at_"
    frame.withColumn(at, F.monotonically_increasing_id()).write.mode("overwrite").parquet(staged)
    laid = spark.read.schema(T.StructType([*frame.schema.fields, T.StructField(at, T.LongType())])).parquet(staged)
    task = F.shiftright(at, NUMBER_BITS)
    counts = laid.groupBy(task.alias("task")).count().orderBy("task").collect()  # one per task
    sizes = [row["count"] for row in counts]
    first = claimed(spark, path, batch_id, run, sum(sizes))
    starts = [first + before for before in accumulate([0, *sizes[:-1]])] if sizes else []
    offsets = spark.createDataFrame([(row["task"], start) for row, start in zip(counts, starts)], "_task LONG, _start LONG")
    keyed = laid.join(F.broadcast(offsets), task == F.col("_task"))  # one per task as well
    key = F.col("_start") + F.col(at).bitwiseAND((1 << NUMBER_BITS) - 1)
    return keyed.select(*frame.columns, key.alias(name))


def keyed(path: str, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that hands the batch on to the table's sink with its keys."""

    def run(frame: DataFrame, batch_id: int) -> None:
        write(with_dense_ids(frame, path, batch_id), batch_id)

    return run
