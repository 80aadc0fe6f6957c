"""Records as text: message lines and short debug renderings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Quote only where needed, double inner quotes, NULL and '' become empty fields.
LINE_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def moment_text(moment: Column, fraction: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, followed by six fraction digits where ``fraction`` holds.

    A zoned time, as a database may give it, is shown in the session zone.
    """
    plain = moment.cast("string")
    dotted = F.when(F.length(plain) == 19, F.concat(plain, F.lit("."))).otherwise(plain)
    return F.when(fraction, F.rpad(dotted, 26, "0")).otherwise(F.substring(plain, 1, 19))


def has_fraction(moment: Column) -> Column:
    return F.length(moment.cast("string")) > 19


def number_text(number: Column) -> Column:
    """A double, without an exponent where a fixed-point text is usual (1e-4 to 1e16)."""
    text = number.cast("string")
    size = F.abs(number)
    plain = F.regexp_replace(
        number.try_cast("decimal(38,20)").cast("string"), r"(\.[0-9]+?)0+$", "$1"
    )
    awkward = F.contains(text, F.lit("E")) & (size >= 1e-4) & (size < 1e16)
    return F.when(awkward, plain).otherwise(text)


def line_text(schema: T.StructType, always_fraction: bool = False) -> Column:
    """One row of ``schema`` as a message line.

    Times are cut to whole seconds only when every time of the row is whole:
    the parser wants one form per line.
    """
    kinds = (T.TimestampNTZType, T.TimestampType)
    times = [f.name for f in schema.fields if isinstance(f.dataType, kinds)]
    fraction = F.lit(always_fraction)
    if not always_fraction:
        for name in times:
            fraction = fraction | F.coalesce(has_fraction(F.col(name)), F.lit(False))

    def field(item: T.StructField) -> Column:
        column = F.col(item.name)
        if item.name in times:
            column = moment_text(column, fraction)
        elif isinstance(item.dataType, T.DoubleType):
            column = number_text(column)
        return column.alias(item.name)

    return F.to_csv(F.struct(*(field(item) for item in schema.fields)), LINE_OPTIONS)


# The eight trip fields worth showing when following a stream.
TRIP_DEBUG_FIELDS = [
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "trip_duration",
]


def trip_debug() -> Column:
    return F.to_json(F.struct(*TRIP_DEBUG_FIELDS))


def hourly_debug() -> Column:
    return F.to_json(F.struct("hour", "window_start", "window_end", "average_fare", "trip_count"))
