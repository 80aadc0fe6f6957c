"""Database tables as append-only sinks.

Delivery is at least once: a batch repeated after a failure adds its rows
again. URL, user and password come from the caller in ``connection``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.schemas import DECODED, HOURLY, TRIP


@dataclass(frozen=True)
class Target:
    """A table, its columns in insert order, its rows per insert and its indexed columns.

    Flush intervals and retries are not kept per table: the trigger of the query sets
    the one, ``spark.task.maxFailures`` the other, for all tables that it feeds.
    """

    table: str
    schema: T.StructType
    batch_rows: int
    texts: str
    indexed: tuple[tuple[str, ...], ...] = ()

    def select(self, frame: DataFrame) -> DataFrame:
        return frame.select(*(F.col(f.name).cast(f.dataType) for f in self.schema.fields))


# Rows per insert batch, text widths, indexed columns.
RAW = Target(
    "taxi_trips",
    TRIP,
    100,
    "store_and_fwd_flag VARCHAR(1)",
    (("pickup_datetime",),),
)
DECODED_TRIPS = Target(
    "yellow_taxi_stream",
    DECODED,
    20,
    "vendor_name VARCHAR(50), rate_code_name VARCHAR(50), "
    "store_and_fwd_flag VARCHAR(1), payment_type_name VARCHAR(50)",
)
HOURLY_FARES = Target(
    "hourly_aggregates",
    T.StructType([*HOURLY.fields[:-1], T.StructField("trip_count", T.IntegerType())]),
    10,
    "",
    (("hour",), ("window_start", "window_end")),
)
TARGETS = (RAW, DECODED_TRIPS, HOURLY_FARES)

FLAG_WIDTH = 1
#: Connections that a write opens at one time unless the caller says otherwise.
WRITERS = 16
SQL_TYPES = {
    T.IntegerType(): "INTEGER",
    T.LongType(): "BIGINT",
    T.DoubleType(): "DOUBLE PRECISION",
    T.TimestampNTZType(): "TIMESTAMP",
}


def refuse_wide_flags(classified: DataFrame) -> DataFrame:
    """Classified lines with reason ``flag_width`` where the flag does not fit VARCHAR(1).

    One such row would fail its whole insert batch on every retry.
    """
    wide = F.col("reason").isNull() & (F.length("store_and_fwd_flag") > FLAG_WIDTH)
    return classified.withColumn(
        "reason", F.when(wide, "flag_width").otherwise(F.col("reason"))
    )


def write_options(
    target: Target,
    url: str,
    connection: dict[str, str] | None = None,
    batch_rows: int | None = None,
) -> dict[str, str]:
    """Writer options; ``batch_rows`` overrides the rows per insert batch."""
    options = {
        "url": url,
        "dbtable": target.table,
        "batchsize": str(batch_rows or target.batch_rows),
        **(connection or {}),
    }
    if target.texts:
        options["createTableColumnTypes"] = target.texts
    return options


def jdbc_sink(
    target: Target, url: str, writers: int = WRITERS, **options
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends to ``target``.

    ``writers`` bounds the connections open at one time. The rows are spread
    over them by a shuffle: the writer's own limit would coalesce, and so run
    the parsing before it in as few tasks.
    """
    settings = write_options(target, url, **options)

    def write(frame: DataFrame, batch_id: int) -> None:
        rows = target.select(frame).repartition(writers)
        rows.write.format("jdbc").options(**settings).mode("append").save()

    return write


def replace_jdbc_table(frame: DataFrame, url: str, table: str, **connection: str) -> None:
    """The whole database table from one frame."""
    settings = {"url": url, "dbtable": table, **connection}
    frame.write.format("jdbc").options(**settings).mode("overwrite").save()


def ddl(target: Target, created_at: bool = False) -> str:
    """The table with its serial key, for databases that know SERIAL."""
    widths = dict(part.rsplit(" ", 1) for part in target.texts.split(", ") if part)
    columns = [
        f"{f.name} {widths.get(f.name) or SQL_TYPES[f.dataType]}" for f in target.schema.fields
    ]
    if created_at:
        columns.append("created_at TIMESTAMP DEFAULT CURRENT_TIMESTAMP")
    return f"CREATE TABLE IF NOT EXISTS {target.table} (id SERIAL PRIMARY KEY, {', '.join(columns)})"


def index_ddl(target: Target) -> list[str]:
    """The indexes of the table, to be run in the database after ``ddl``."""
    return [
        f"CREATE INDEX IF NOT EXISTS idx_{target.table}_{columns[0]} "
        f"ON {target.table} ({', '.join(columns)})"
        for columns in target.indexed
    ]


def create_keyless_jdbc_tables(spark: SparkSession, url: str, **options) -> None:
    """Create the missing tables, without the serial key, by appending no rows.

    Where the key is wanted, run ``ddl`` in the database first: appends name
    their columns, so the database fills the key. Failures are raised.
    """
    for target in TARGETS:
        jdbc_sink(target, url, **options)(spark.createDataFrame([], target.schema), 0)
