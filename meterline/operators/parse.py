"""Message lines to typed trips, with a reason for every line turned away."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.functions.clock import duration_seconds
from meterline.functions.fields import (
    split_fields,
    strict_doubles,
    strict_ints,
    trimmed,
    with_strict_times,
)
from meterline.schemas import LINE_FIELDS, TRIP

# What a header line starts with, and the number of fields needed.
HEADER_START = "VendorID"
FIELD_COUNT = 19

REASONS = ["header", "blank", "arity", "number", "datetime"]


# Places of the fields of each type in a line.
KINDS = [f.dataType for f in LINE_FIELDS]
INT_PLACES = [place for place, kind in enumerate(KINDS) if kind == T.IntegerType()]
DOUBLE_PLACES = [place for place, kind in enumerate(KINDS) if kind == T.DoubleType()]
TIME_PLACES = [place for place, kind in enumerate(KINDS) if kind == T.TimestampNTZType()]
(FLAG_PLACE,) = (place for place, kind in enumerate(KINDS) if kind == T.StringType())


def _at(array: str, place: int) -> Column:
    return F.get(array, F.lit(place))


def _fields() -> list[Column]:
    """The 19 typed fields out of the arrays they were cast in."""
    homes = {FLAG_PLACE: F.col("_flag")}
    for array, places in (
        ("_ints", INT_PLACES),
        ("_doubles", DOUBLE_PLACES),
        ("_times", TIME_PLACES),
    ):
        homes.update({place: _at(array, slot) for slot, place in enumerate(places)})
    return [homes[place].alias(name) for place, name in enumerate(LINE_FIELDS.fieldNames())]


def _reason(line: Column) -> Column:
    """Why a line is no trip; NULL for a trip. The first failing test names the reason.

    Headers come first and blank lines second. A header has no vendor and a
    blank line one field, so good lines are spared both text tests.
    """
    times = ("pickup_datetime", "dropoff_datetime")
    numbers = [n for n in LINE_FIELDS.fieldNames() if n not in (*times, "vendor_id")]

    def missing(names) -> Column:
        return reduce(or_, (F.col(name).isNull() for name in names))

    header = F.when(line.startswith(HEADER_START), "header")
    short = header.when(trimmed(F.coalesce(line, F.lit(""))) == "", "blank").otherwise("arity")
    return (
        F.when(F.coalesce(F.col("_arity"), F.lit(0)) < FIELD_COUNT, short)
        .when(F.col("vendor_id").isNull(), header.otherwise("number"))
        .when(missing(times), "datetime")
        .when(missing(numbers), "number")
    )


def classify(lines: DataFrame, column: str = "value") -> DataFrame:
    """Every line with its 20 trip columns and ``reason`` (NULL for a good line).

    Other columns of ``lines`` (the record time, say) are carried along, so a
    watermark set on one of them stays in force.

    The parsed fields pass through ``inline`` of a one-element array. Without
    that step Catalyst moves a later filter on ``reason`` below the projection
    and so repeats the split of the line for every field (about ten times the
    work); with it each line is split and parsed once, still inside one
    generated stage.
    """
    carried = lines.columns
    names = LINE_FIELDS.fieldNames()
    cut = lines.withColumn("_parts", split_fields(F.col(column)))
    texts = cut.select(
        *carried,
        F.size("_parts").alias("_arity"),
        F.array(*(_at("_parts", place) for place in INT_PLACES)).alias("_int_texts"),
        F.array(*(_at("_parts", place) for place in DOUBLE_PLACES)).alias("_double_texts"),
        *(trimmed(_at("_parts", place)).alias(f"_time_{place}") for place in TIME_PLACES),
        trimmed(_at("_parts", FLAG_PLACE)).alias("_flag"),
    )
    timed = with_strict_times(texts, *(f"_time_{place}" for place in TIME_PLACES), "_times")
    typed = timed.select(
        *carried,
        "_arity",
        strict_ints(F.col("_int_texts"), F.col(column)).alias("_ints"),
        strict_doubles(F.col("_double_texts")).alias("_doubles"),
        "_times",
        "_flag",
    )
    parsed = ("_arity", "_ints", "_doubles", "_times", "_flag")
    fenced = typed.select(*carried, F.inline(F.array(F.struct(*parsed))))
    return (
        fenced.select(*carried, "_arity", *_fields())
        .select(
            *carried,
            *names,
            duration_seconds(F.col("pickup_datetime"), F.col("dropoff_datetime")).alias(
                "trip_duration"
            ),
            _reason(F.col(column)).alias("reason"),
        )
    )


def trips(classified: DataFrame, column: str = "value") -> DataFrame:
    """The good lines as trips, followed by the carried columns."""
    names = TRIP.fieldNames()
    carried = [c for c in classified.columns if c not in (*names, "reason", column)]
    return classified.filter(F.col("reason").isNull()).select(*names, *carried)


def rejects(classified: DataFrame) -> DataFrame:
    """The lines turned away, each with its reason and the carried columns."""
    carried = [c for c in classified.columns if c not in TRIP.fieldNames()]
    return classified.filter(F.col("reason").isNotNull()).select(*carried)


def reject_counts(classified: DataFrame) -> DataFrame:
    """Lines per reason."""
    return rejects(classified).groupBy("reason").agg(F.count("*").alias("line_count"))


def watch_reasons(classified: DataFrame, watch: Observation | str) -> DataFrame:
    """The same rows, counted by outcome while they pass.

    An ``Observation`` serves a batch; a name shows up in a stream's progress.
    """
    counts = [F.count_if(F.col("reason") == name).alias(name) for name in REASONS]
    return classified.observe(watch, F.count("*").alias("lines"), *counts)


def parse_trips(lines: DataFrame, column: str = "value") -> DataFrame:
    return trips(classify(lines, column), column)
