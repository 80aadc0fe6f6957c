"""Which files of a table hold which values: an index by file, consulted before a scan.

The index of a table has a row per file with the least and the greatest value of some columns. A batch's
rows are added when its files are written, from those columns alone, and are replaced with the
batch. A lookup compares the wanted spans with these rows and opens the files that may have
them. Files help when their rows are close in these columns, as sorted sinks write them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.sinks.commits import only_committed
from meterline.sinks.tables import batch_path, read_table, run_of

FILE = "file"


def _index(path: str) -> str:
    return f"{path.rstrip('/')}_files"


def index_batch(spark: SparkSession, path: str, columns: T.StructType, batch_id: int, run: str) -> None:
    """Index the files of a batch by the columns, as the table declares them."""
    rows = spark.read.schema(columns).parquet(batch_path(path, run, batch_id))
    spans = [F.struct(F.min(name).alias("least"), F.max(name).alias("greatest")).alias(name) for name in columns.names]
    files = rows.groupBy(F.col("_metadata.file_path").alias(FILE)).agg(F.count("*").alias("row_count"), *spans)
    files.hint("rebalance").write.mode("overwrite").parquet(batch_path(_index(path), run, batch_id))


def indexed(path: str, columns: T.StructType, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that indexes the files that the table's sink has written."""

    def run(frame: DataFrame, batch_id: int) -> None:
        write(frame, batch_id)
        index_batch(frame.sparkSession, path, columns, batch_id, run_of(frame))

    return run


@dataclass(frozen=True)
class Found:
    """The wanted rows, and how many of the table's files they are read from."""

    rows: DataFrame
    files_read: int
    files: int


def lookup(
    spark: SparkSession, path: str, schema: T.StructType, commits: str | None = None, **spans: tuple[Any, Any]
) -> Found:
    """Rows whose columns lie in the ``spans`` (least and greatest value, None for no bound).

    The names of matching files reach the driver, as those of all files do in a plain read.
    """
    files = spark.read.parquet(_index(path))
    if commits is not None:
        files = only_committed(files, commits)
    may_have, has = F.lit(True), F.lit(True)
    for name, (least, greatest) in spans.items():
        kind, column = schema[name].dataType, F.col(name)

        def value(bound: Any) -> Column:
            return F.lit(bound).cast(kind)

        if least is not None:
            may_have, has = may_have & (column["greatest"] >= value(least)), has & (column >= value(least))
        if greatest is not None:
            may_have, has = may_have & (column["least"] <= value(greatest)), has & (column <= value(greatest))
    names = [row[FILE] for row in files.filter(may_have).select(FILE).collect()]
    if not names:
        return Found(read_table(spark, path, schema).filter(F.lit(False)), 0, files.count())
    return Found(read_table(spark, path, schema, names).filter(has), len(names), files.count())
