"""Trip-time expressions. All of them are independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def duration_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, cut toward zero; negative when reversed."""
    return (end - start).cast("interval second").cast("bigint")


def hour_of_day(moment: Column) -> Column:
    return F.hour(moment)


def epoch_millis(moment: Column) -> Column:
    """Milliseconds since 1970 of a zone-less time read as UTC, rounded down."""
    elapsed = (moment - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")).cast("interval second")
    return F.floor(elapsed.cast("decimal(20,6)") * 1000).cast("bigint")


def whole_seconds(moment: Column) -> Column:
    """The time without its fraction."""
    return F.make_timestamp_ntz(
        F.year(moment),
        F.month(moment),
        F.dayofmonth(moment),
        F.hour(moment),
        F.minute(moment),
        F.second(moment),
    )
