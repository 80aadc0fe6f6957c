"""The fixed record types: message, trip, decoded trip, hourly aggregate."""

from __future__ import annotations

from pyspark.sql import types as T

INT, LONG, DOUBLE, TEXT, TIME = (
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.StringType(),
    T.TimestampNTZType(),
)


def _record(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


# One message of the topic: the line and the record time the broker gave it.
MESSAGE = T.StructType(
    [T.StructField("value", TEXT, True), T.StructField("timestamp", T.TimestampType(), True)]
)

# The nine money columns shared by trips and decoded trips.
AMOUNTS = [
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
]

# The 19 fields of a line, in line order.
LINE_FIELDS = _record(
    ("vendor_id", INT),
    ("pickup_datetime", TIME),
    ("dropoff_datetime", TIME),
    ("passenger_count", INT),
    ("trip_distance", DOUBLE),
    ("rate_code_id", INT),
    ("store_and_fwd_flag", TEXT),
    ("pu_location_id", INT),
    ("do_location_id", INT),
    ("payment_type", INT),
    *((name, DOUBLE) for name in AMOUNTS),
)

TRIP = T.StructType([*LINE_FIELDS.fields, T.StructField("trip_duration", LONG, True)])

DECODED = _record(
    ("vendor_name", TEXT),
    ("pickup_datetime", TIME),
    ("dropoff_datetime", TIME),
    ("passenger_count", INT),
    ("trip_distance", DOUBLE),
    ("rate_code_name", TEXT),
    ("store_and_fwd_flag", TEXT),
    ("pu_location_id", INT),
    ("do_location_id", INT),
    ("payment_type_name", TEXT),
    *((name, DOUBLE) for name in AMOUNTS),
)

# The count is a long: a replay puts a whole history into one window of record
# time, and more than 2^31 trips must not end the job.
HOURLY = _record(
    ("hour", INT),
    ("window_start", TIME),
    ("window_end", TIME),
    ("average_fare", DOUBLE),
    ("trip_count", LONG),
)

# The header of the trip files, in file order.
CSV_HEADER = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "store_and_fwd_flag",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "Airport_fee",
]

CSV_TIMES = ["tpep_pickup_datetime", "tpep_dropoff_datetime"]

# The loaded table: the file's own column names with the trip types.
CSV_TRIP = T.StructType(
    [
        T.StructField(name, field.dataType, True)
        for name, field in zip(CSV_HEADER, LINE_FIELDS.fields, strict=True)
    ]
)
