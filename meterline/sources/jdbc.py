"""A database table as a DataFrame, read by several connections at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_read_options(
    url: str,
    table: str,
    column: str | None = None,
    lower: str | int | None = None,
    upper: str | int | None = None,
    partitions: int = 64,
    fetch_rows: int = 10_000,
    connection: dict[str, str] | None = None,
) -> dict[str, str]:
    """Reader options; with a split ``column`` and its bounds the scan is parallel.

    The bounds only place the cuts: rows outside them are read as well. Without a split
    column one connection reads the whole table, which only suits a small one.
    """
    options = {
        "url": url,
        "dbtable": table,
        "fetchsize": str(fetch_rows),
        "preferTimestampNTZ": "true",
        **(connection or {}),
    }
    if column is not None:
        if lower is None or upper is None:
            raise ValueError("a split column needs both bounds")
        options.update(
            partitionColumn=column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return options


def jdbc_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_read_options(url, table, **options)).load()
