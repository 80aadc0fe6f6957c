"""Trips with codes replaced by names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.clock import whole_seconds
from meterline.functions.codes import payment_type_name, rate_code_name, vendor_name
from meterline.schemas import DECODED


def decode(trips: DataFrame) -> DataFrame:
    """The 19 decoded columns: names for codes, times in whole seconds, no duration."""
    changed = {
        "vendor_name": vendor_name(F.col("vendor_id")),
        "rate_code_name": rate_code_name(F.col("rate_code_id")),
        "payment_type_name": payment_type_name(F.col("payment_type")),
        "pickup_datetime": whole_seconds(F.col("pickup_datetime")),
        "dropoff_datetime": whole_seconds(F.col("dropoff_datetime")),
    }
    return trips.select(
        *(changed.get(name, F.col(name)).alias(name) for name in DECODED.fieldNames())
    )
