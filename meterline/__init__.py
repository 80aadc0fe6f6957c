"""Taxi-trip analytics on Spark: load, publish, parse, decode and aggregate.

Every operator takes and returns DataFrames; the ones that make sense on a
stream accept a streaming DataFrame unchanged.
"""

from meterline.operators.decode import decode
from meterline.operators.hourly import hourly_fares, latest
from meterline.operators.load import load_trips
from meterline.operators.parse import classify, parse_trips, reject_counts, rejects, trips
from meterline.operators.publish import publish_lines

__all__ = [
    "classify",
    "decode",
    "hourly_fares",
    "latest",
    "load_trips",
    "parse_trips",
    "publish_lines",
    "reject_counts",
    "rejects",
    "trips",
]
