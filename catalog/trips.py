"""Trips, lines and replays derived from the whole ``events`` table."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.functions.text import line_text, moment_text
from meterline.schemas import CSV_HEADER, LINE_FIELDS
from meterline.sinks.topic import message_files


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _turn(codes: list[int]) -> Column:
    """The code of an event: its id picks one of ``codes`` in turn."""
    return F.get(F.array(*map(F.lit, codes)), F.col("event_id") % len(codes)).cast("int")


def event_trips(rows: DataFrame, *carried: str | Column) -> DataFrame:
    """One trip per event, times and amounts varying with its columns."""
    error = F.col("event_type") == "error"
    fare = F.when(error, -F.col("value")).otherwise(F.col("value"))
    later = F.make_dt_interval(secs=(F.col("event_id") % 3600).cast("decimal(18,6)"))
    start = F.col("ts").cast("timestamp_ntz")
    columns = {
        "vendor_id": _turn([1, 2, 6, 7, 3]),
        "pickup_datetime": start,
        "dropoff_datetime": start + later,
        "passenger_count": (F.col("user_id") % 5).cast("int"),
        "trip_distance": F.col("value") * 0.25,
        "rate_code_id": _turn([1, 2, 3, 4, 5, 6, 99, 42]),
        "store_and_fwd_flag": F.when(error, "Y").otherwise("N"),
        "pu_location_id": (F.col("user_id") % 265 + 1).cast("int"),
        "do_location_id": (F.col("event_id") % 265 + 1).cast("int"),
        "payment_type": _turn([0, 1, 2, 3, 4, 5, 6, 7]),
        "fare_amount": fare,
        "extra": F.lit(1.0),
        "mta_tax": F.lit(0.5),
        "tip_amount": F.lit(0.0),
        "tolls_amount": F.lit(0.0),
        "improvement_surcharge": F.lit(1.0),
        "total_amount": fare + 5.0,
        "congestion_surcharge": F.lit(2.5),
        "airport_fee": F.lit(0.0),
    }
    return rows.select(
        *(columns[name].alias(name) for name in LINE_FIELDS.fieldNames()), *carried
    )


def messages(frame: DataFrame, value: Column) -> DataFrame:
    """Lines with the pickup as record time.

    The one-element ``inline`` makes Spark generate the making of a line as a
    method of its own, apart from the parsing that follows in the same stage;
    together they are too long for the JVM to compile.
    """
    lines = frame.select(
        value.alias("value"), F.col("pickup_datetime").cast("timestamp").alias("timestamp")
    )
    return lines.select(F.inline(F.array(F.struct("value", "timestamp"))))


def event_lines(rows: DataFrame) -> DataFrame:
    """Every event as a good line."""
    return messages(event_trips(rows), line_text(LINE_FIELDS))


def flawed_lines(rows: DataFrame) -> DataFrame:
    """Every event as a line; fifteen in a hundred ids get a twist, most of them flaws."""
    kind = (F.col("event_id") % 100).alias("kind")
    trips = event_trips(rows, kind)
    texts = {name: F.col(name).cast("string") for name in LINE_FIELDS.fieldNames()}
    for name in ("pickup_datetime", "dropoff_datetime"):
        texts[name] = moment_text(F.col(name), F.lit(True))

    def twist(name: str, changes: dict[int, Column]) -> None:
        changed = texts[name]
        for number, text in changes.items():
            changed = F.when(F.col("kind") == number, text).otherwise(changed)
        texts[name] = changed

    def cut(name: str) -> Column:
        return F.substring(texts[name], 1, 19)

    def marked(name: str) -> Column:
        return F.replace(texts[name], F.lit(" "), F.lit("T"))

    pickup, dropoff = "pickup_datetime", "dropoff_datetime"
    twist(pickup, {8: marked(pickup), 9: F.lit("soon"), 10: cut(pickup)})
    twist(dropoff, {7: cut(dropoff), 8: marked(dropoff), 9: F.lit("later"), 10: cut(dropoff)})
    twist("vendor_id", {9: F.lit("x"), 13: F.lit("+1")})
    twist("passenger_count", {4: F.lit("1.0"), 5: F.lit("")})
    twist("fare_amount", {6: F.lit("nan")})
    twist("store_and_fwd_flag", {14: F.lit("")})
    twist("airport_fee", {3: F.lit("")})
    line = trips.select(
        "kind", "pickup_datetime", F.concat_ws(",", *texts.values()).alias("line")
    )
    padded = F.concat(F.lit(" "), F.replace("line", F.lit(","), F.lit(" , ")), F.lit(" "))
    value = (
        F.when(F.col("kind") > 14, F.col("line"))
        .when(F.col("kind") == 0, ",".join(CSV_HEADER))
        .when(F.col("kind") == 1, "   ")
        .when(F.col("kind") == 2, F.substring_index("line", ",", 18))
        .when(F.col("kind") == 11, padded)
        .when(F.col("kind") == 12, F.concat("line", F.lit(",spare")))
        .otherwise(F.col("line"))
    )
    return messages(line, value)


# A replay is cut into this many slices of record time.
SLICES = 3


def slice_bounds(rows: DataFrame) -> list[datetime]:
    """The times between the slices: five minutes past the full hours that split the span evenly.

    A scan of one column, with partial extremes per task.
    """
    low, high = rows.agg(F.min("ts"), F.max("ts")).first()
    step = (high - low) / SLICES
    return [
        (low + step * part).replace(minute=0, second=0, microsecond=0) + timedelta(minutes=5)
        for part in range(1, SLICES)
    ]


# A replay of more days than these has its trips laid out by month.
MOST_DAYS = 100


def many_days(rows: DataFrame) -> bool:
    """Whether a file per day and slice would be a great many small ones."""
    low, high = rows.agg(F.min("ts"), F.max("ts")).first()
    return low is not None and high - low > timedelta(days=MOST_DAYS)


def dealt(rows: DataFrame) -> DataFrame:
    """The rows over all cores.

    A slice of a table in time order lies in few of its files' row groups, and as many
    tasks would make its lines and parse them.
    """
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def slices(rows: DataFrame, bounds: list[datetime], column: Column) -> Iterator[DataFrame]:
    """The rows of each slice of ``column``; a filter on ``ts`` reaches the scan."""
    edges = [None, *bounds, None]
    for low, high in zip(edges, edges[1:]):
        part = rows
        if low is not None:
            part = part.filter(column >= F.lit(low))
        if high is not None:
            part = part.filter(column < F.lit(high))
        yield part


def closing_line(rows: DataFrame, after: timedelta) -> DataFrame:
    """A blank line so long after the last event that all windows are over."""
    last = rows.agg(F.max("ts").cast("timestamp").alias("last"))
    return last.select(F.lit("").alias("value"), (F.col("last") + F.lit(after)).alias("timestamp"))


def replay(
    parts: Iterator[DataFrame], landing: str, run: Callable[[], None]
) -> None:
    """Land one slice at a time and let ``run`` take it in before the next one comes.

    The stream sees the slices in order whatever the age of their files, and
    each one is a single batch over all executors.
    """
    for part in parts:
        message_files(part, landing)
        run()
