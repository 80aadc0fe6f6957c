from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

from conftest import SAMPLE, trip_line
from meterline.functions.clock import epoch_millis, whole_seconds
from meterline.functions.codes import payment_type_name, rate_code_name, vendor_name
from meterline.functions.text import hourly_debug, trip_debug
from meterline.operators.hourly import hourly_fares
from meterline.operators.decode import decode
from meterline.operators.parse import parse_trips
from meterline.schemas import DECODED


def test_every_code_and_the_default(spark):
    codes = spark.createDataFrame([(code,) for code in (*range(-1, 9), 98, 99, None)], "c INT")
    rows = codes.select(
        "c",
        vendor_name(F.col("c")).alias("vendor"),
        rate_code_name(F.col("c")).alias("rate"),
        payment_type_name(F.col("c")).alias("payment"),
    ).collect()
    found = {row.c: (row.vendor, row.rate, row.payment) for row in rows}
    unknown = "Unknown Vendor"
    assert found == {
        -1: (unknown, "Other", "Other"),
        0: (unknown, "Other", "Flex Fare trip"),
        1: ("Creative Mobile Technologies, LLC", "Standard rate", "Credit card"),
        2: ("Curb Mobility, LLC", "JFK", "Cash"),
        3: (unknown, "Newark", "No charge"),
        4: (unknown, "Nassau or Westchester", "Dispute"),
        5: (unknown, "Negotiated fare", "Unknown"),
        6: ("Myle Technologies Inc", "Group ride", "Voided trip"),
        7: ("Helix", "Other", "Other"),
        8: (unknown, "Other", "Other"),
        98: (unknown, "Other", "Other"),
        99: (unknown, "Null/unknown", "Other"),
        None: (unknown, "Other", "Other"),
    }


def test_decoded_record(lines):
    text = trip_line(
        tpep_pickup_datetime="2025-01-01 00:12:05.999999",
        tpep_dropoff_datetime="2025-01-01 00:31:20.500000",
    )
    frame = decode(parse_trips(lines(text)))
    assert frame.schema.simpleString() == DECODED.simpleString()
    row = frame.first()
    assert row.pickup_datetime == datetime(2025, 1, 1, 0, 12, 5)
    assert row.dropoff_datetime == datetime(2025, 1, 1, 0, 31, 20)
    assert row.vendor_name == "Creative Mobile Technologies, LLC"
    assert "trip_duration" not in frame.columns


def test_clock_before_the_epoch(spark):
    frame = spark.sql("SELECT TIMESTAMP_NTZ'1969-12-31 23:59:59.9995' AS t")
    row = frame.select(epoch_millis(F.col("t")), whole_seconds(F.col("t"))).first()
    assert row[0] == -1
    assert row[1] == datetime(1969, 12, 31, 23, 59, 59)


def test_debug_text(lines):
    text = parse_trips(lines(SAMPLE[0])).select(trip_debug()).first()[0]
    shown = json.loads(text)
    assert len(shown) == 8
    assert shown["fare_amount"] == 21.5
    assert shown["trip_duration"] == 1155


def test_hourly_debug_text(lines):
    hourly = hourly_fares(parse_trips(lines(SAMPLE[0])), "pickup_datetime")
    shown = json.loads(hourly.select(hourly_debug()).first()[0])
    assert shown["hour"] == 0
    assert shown["trip_count"] == 1
    assert shown["window_end"].startswith("2025-01-01T01:00:00")
