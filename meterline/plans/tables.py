"""Files to the loaded table, and the table back out as lines, in one job or as a replay that goes on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from meterline.operators.load import load_trips
from meterline.operators.publish import publish_lines
from meterline.sinks.tables import replace_table
from meterline.sources.files import table_stream
from meterline.streaming.hourly import checkpointed


def load_table(
    spark: SparkSession, files: str, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Replace the table at ``path`` by the trip files; gives back the stored table."""
    replace_table(load_trips(spark, files, schema), path)
    return spark.read.parquet(path)


def publish_table(
    table: DataFrame, write: Callable[[DataFrame], None], rows: int | None = None
) -> int:
    """Write the table's lines with ``write`` and give back how many there were.

    A failed write is tried again by Spark and raised in the end; no line is
    passed over.
    """
    seen = Observation()
    write(publish_lines(table, rows, published=seen))
    return seen.get["lines"]


def start_replay(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    files_per_batch: int | None = None,
    bytes_per_batch: str | None = None,
    interval: str | None = None,
    name: str = "replay",
) -> StreamingQuery:
    """Publish a stored table as lines in bounded batches, as a query that goes on where it stopped.

    The checkpoint keeps which files are out. A batch that failed is written again with the
    same rows, so ``write`` must replace what it wrote of that batch before; ``topic.line_batches``
    does, a topic gets such a batch's lines twice. Files that are added to the table
    later are published as well. The ``interval`` between batches and their size set the rate.
    """
    lines = publish_lines(table_stream(spark, path, schema, files_per_batch, bytes_per_batch))
    return checkpointed(lines.writeStream.foreachBatch(write), name, checkpoint, interval).start()
