"""Trips back to message lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from meterline.functions.text import line_text


#: A row's number within its task is kept in so many low bits of its increasing id.
NUMBER_BITS = 33


def first_rows(table: DataFrame, rows: int) -> DataFrame:
    """Exactly ``rows`` rows of a stored table, or all if it has fewer, from as many tasks as hold them.

    Rows are counted per task; whole tasks are kept as long as they fit, and the next one
    is cut. The table is read twice, so it must be dealt to tasks the same way each time,
    as files are.
    """
    task, left = F.spark_partition_id(), rows
    counts = table.groupBy(task.alias("task")).count().orderBy("task").collect()  # one per task
    whole, cut, part = -1, -1, 0
    for row in counts:
        if row["count"] > left:
            cut, part = row["task"], left
            break
        whole, left = row["task"], left - row["count"]
    number = F.monotonically_increasing_id().bitwiseAND((1 << NUMBER_BITS) - 1)
    return table.filter((task <= whole) | (task == cut) & (number < part))


def publish_lines(
    table: DataFrame,
    rows: int | None = None,
    always_fraction: bool = False,
    published: Observation | None = None,
) -> DataFrame:
    """Each row of ``table``, columns in table order, as one line in ``value``.

    ``rows`` caps the replay of a stored table, as a feature of the caller; the default
    publishes everything. ``published`` counts the lines while they are written.
    """
    capped = table if rows is None else first_rows(table, rows)
    lines = capped.select(line_text(table.schema, always_fraction).alias("value"))
    return lines if published is None else lines.observe(published, F.count("*").alias("lines"))
