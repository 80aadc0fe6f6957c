"""The registered queries as SQL over the same tables."""

from __future__ import annotations

# Fixed values, spelled out here once more so that a slip in the engine shows.
LINE_FIELDS = """vendor_id pickup_datetime dropoff_datetime passenger_count trip_distance
rate_code_id store_and_fwd_flag pu_location_id do_location_id payment_type fare_amount extra
mta_tax tip_amount tolls_amount improvement_surcharge total_amount congestion_surcharge
airport_fee""".split()
CSV_HEADER = """VendorID tpep_pickup_datetime tpep_dropoff_datetime passenger_count trip_distance
RatecodeID store_and_fwd_flag PULocationID DOLocationID payment_type fare_amount extra
mta_tax tip_amount tolls_amount improvement_surcharge total_amount congestion_surcharge
Airport_fee""".split()
AMOUNTS = LINE_FIELDS[10:]
# The replay's slices, and the delay of the watermark in the delayed one.
SLICES = 3
DELAY = "11 DAY"

FIELDS = ", ".join(LINE_FIELDS)

TRIPS = """
trips AS (
  SELECT event_id,
    CAST([1, 2, 6, 7, 3][event_id % 5 + 1] AS INTEGER) AS vendor_id,
    ts AS pickup_datetime,
    ts + to_seconds(event_id % 3600) AS dropoff_datetime,
    CAST(user_id % 5 AS INTEGER) AS passenger_count,
    value * 0.25 AS trip_distance,
    CAST([1, 2, 3, 4, 5, 6, 99, 42][event_id % 8 + 1] AS INTEGER) AS rate_code_id,
    CASE WHEN event_type = 'error' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(user_id % 265 + 1 AS INTEGER) AS pu_location_id,
    CAST(event_id % 265 + 1 AS INTEGER) AS do_location_id,
    CAST(event_id % 8 AS INTEGER) AS payment_type,
    CASE WHEN event_type = 'error' THEN -value ELSE value END AS fare_amount,
    CAST(1.0 AS DOUBLE) AS extra,
    CAST(0.5 AS DOUBLE) AS mta_tax,
    CAST(0.0 AS DOUBLE) AS tip_amount,
    CAST(0.0 AS DOUBLE) AS tolls_amount,
    CAST(1.0 AS DOUBLE) AS improvement_surcharge,
    CASE WHEN event_type = 'error' THEN -value ELSE value END + CAST(5.0 AS DOUBLE)
      AS total_amount,
    CAST(2.5 AS DOUBLE) AS congestion_surcharge,
    CAST(0.0 AS DOUBLE) AS airport_fee
  FROM events
)"""

DURATION = "date_sub('second', pickup_datetime, dropoff_datetime) AS trip_duration"

# What becomes of the ids with each remainder of 100 among the flawed lines.
FLAWS = """CASE
    WHEN event_id % 100 = 0 THEN 'header'
    WHEN event_id % 100 = 1 THEN 'blank'
    WHEN event_id % 100 IN (2, 3) THEN 'arity'
    WHEN event_id % 100 IN (4, 5, 6, 9) THEN 'number'
    WHEN event_id % 100 IN (7, 8) THEN 'datetime'
  END"""

# Remainder 10 writes whole seconds, 13 vendor +1, 14 an empty flag; 0 to 9 are rejected.
FLAWED_TRIPS = f"""
flawed AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 100 = 10 THEN date_trunc('second', pickup_datetime)
      ELSE pickup_datetime END AS pickup_datetime,
    CASE WHEN event_id % 100 = 10 THEN date_trunc('second', dropoff_datetime)
      ELSE dropoff_datetime END AS dropoff_datetime,
    CASE WHEN event_id % 100 = 13 THEN 1 ELSE vendor_id END AS vendor_id,
    CASE WHEN event_id % 100 = 14 THEN '' ELSE store_and_fwd_flag END AS store_and_fwd_flag
  ), {FLAWS} AS reason
  FROM trips
)"""


VENDOR = """CASE vendor_id
    WHEN 1 THEN 'Creative Mobile Technologies, LLC'
    WHEN 2 THEN 'Curb Mobility, LLC'
    WHEN 6 THEN 'Myle Technologies Inc'
    WHEN 7 THEN 'Helix'
    ELSE 'Unknown Vendor' END"""
RATE = """CASE rate_code_id
    WHEN 1 THEN 'Standard rate'
    WHEN 2 THEN 'JFK'
    WHEN 3 THEN 'Newark'
    WHEN 4 THEN 'Nassau or Westchester'
    WHEN 5 THEN 'Negotiated fare'
    WHEN 6 THEN 'Group ride'
    WHEN 99 THEN 'Null/unknown'
    ELSE 'Other' END"""
PAYMENT = """CASE payment_type
    WHEN 0 THEN 'Flex Fare trip'
    WHEN 1 THEN 'Credit card'
    WHEN 2 THEN 'Cash'
    WHEN 3 THEN 'No charge'
    WHEN 4 THEN 'Dispute'
    WHEN 5 THEN 'Unknown'
    WHEN 6 THEN 'Voided trip'
    ELSE 'Other' END"""


def six_digits(mean: str) -> str:
    """The mean as the queries round it: to nine digits, then exactly to six."""
    return f"CAST(round(CAST({mean} AS DECIMAL(24, 9)), 6) AS DOUBLE)"


def name_counts(name: str, case: str) -> str:
    return (
        f"WITH {TRIPS} SELECT {case} AS {name}, count(*) AS trip_count FROM trips GROUP BY {case}"
    )


DECODED = f"""WITH {TRIPS}
SELECT {VENDOR} AS vendor_name,
  CAST(date_trunc('second', pickup_datetime) AS TIMESTAMP) AS pickup_datetime,
  CAST(date_trunc('second', dropoff_datetime) AS TIMESTAMP) AS dropoff_datetime,
  passenger_count, trip_distance, {RATE} AS rate_code_name, store_and_fwd_flag,
  pu_location_id, do_location_id, {PAYMENT} AS payment_type_name, {", ".join(AMOUNTS)}
FROM trips"""


def hourly(moment: str) -> str:
    start = f"CAST(date_trunc('hour', {moment}) AS TIMESTAMP)"
    return f"""WITH {TRIPS}
SELECT CAST(hour(pickup_datetime) AS INTEGER) AS "hour",
  {start} AS window_start,
  {start} + INTERVAL 1 HOUR AS window_end,
  {six_digits('avg(fare_amount)')} AS average_fare,
  count(*) AS trip_count
FROM trips GROUP BY 1, 2, 3"""


HOURLY_PICKUP = hourly("pickup_datetime")
HOURLY_INGEST = hourly("(pickup_datetime + INTERVAL 90 MINUTE)")
RAW = f"WITH {TRIPS} SELECT {FIELDS}, {DURATION} FROM trips"



def fired(disorder: str = "10 SECOND", good: str = "true", lateness: str = "5 MINUTE") -> str:
    """The emission rule of the lateness operator, as CTEs after ``flawed``.

    It follows from each row's slice of arrival and the newest record time of the
    slices before it. All lines move the clock, the ``good`` ones are counted.
    """
    return f"""
span AS (SELECT min(ts) AS low, (max(ts) - min(ts)) / {SLICES} AS step FROM events),
cuts AS (
  SELECT [date_trunc('hour', low + step * part) + INTERVAL 5 MINUTE
          FOR part IN range(1, {SLICES})] AS bounds
  FROM span
),
arrived AS (
  SELECT fare_amount, ts AS moment, {good} AS good,
    date_trunc('hour', ts) AS window_start,
    len(list_filter(bounds, lambda b: ts >= b))
      + CASE WHEN event_id % 20 = 7 THEN 1 ELSE 0 END AS slice
  FROM flawed JOIN events USING (event_id), cuts
),
newest AS (
  SELECT slice, max(max(moment)) OVER (ORDER BY slice) - INTERVAL {disorder} AS watermark
  FROM arrived GROUP BY slice
),
seen AS (
  SELECT a.*, window_start + INTERVAL 1 HOUR AS window_end,
    coalesce(n.watermark >= window_start + INTERVAL 1 HOUR, false) AS due,
    coalesce(n.watermark >= window_start + INTERVAL 1 HOUR + INTERVAL {lateness}, false) AS gone
  FROM arrived a LEFT JOIN newest n ON n.slice = a.slice - 1
  WHERE good
),
kept AS (SELECT * FROM seen WHERE NOT gone),
ontime AS (
  SELECT 'ontime' AS kind, window_start, window_end, -1 AS slice,
    sum(fare_amount) AS total, count(*) AS n
  FROM kept WHERE NOT due AND window_end <= (SELECT max(watermark) FROM newest)
  GROUP BY window_start, window_end
),
refire AS (
  SELECT 'refire' AS kind, late.window_start, late.window_end, late.slice,
    sum(kept.fare_amount) AS total, count(*) AS n
  FROM (SELECT DISTINCT window_start, window_end, slice FROM kept WHERE due) late
  JOIN kept ON kept.window_start = late.window_start AND kept.slice <= late.slice
  GROUP BY late.window_start, late.window_end, late.slice
),
lost AS (
  SELECT 'drop' AS kind, window_start, window_end, slice, sum(fare_amount) AS total, count(*) AS n
  FROM seen WHERE gone GROUP BY window_start, window_end, slice
),
emitted AS (SELECT * FROM ontime UNION ALL SELECT * FROM refire)"""


def late(disorder: str) -> str:
    return f"""WITH {TRIPS}, {FLAWED_TRIPS}, {fired(disorder)}
SELECT CAST(hour(window_start) AS INTEGER) AS "hour",
  CAST(window_start AS TIMESTAMP) AS window_start,
  CAST(window_end AS TIMESTAMP) AS window_end,
  {six_digits('total / n')} AS average_fare, n AS trip_count, kind
FROM (SELECT * FROM emitted UNION ALL SELECT * FROM lost)"""


LATEST = f"""WITH {TRIPS},
log AS (
  SELECT hour(pickup_datetime) AS h, date_trunc('hour', pickup_datetime) AS w,
    batch_id, avg(fare_amount) AS average_fare, count(*) AS trip_count
  FROM trips JOIN (SELECT unnest([0, 1, 2]) AS batch_id) ON event_id % 3 <= batch_id
  GROUP BY 1, 2, 3
)
SELECT CAST(h AS INTEGER) AS "hour", CAST(w AS TIMESTAMP) AS window_start,
  CAST(w AS TIMESTAMP) + INTERVAL 1 HOUR AS window_end,
  {six_digits('average_fare')} AS average_fare, trip_count
FROM log
QUALIFY row_number() OVER (PARTITION BY h, w ORDER BY batch_id DESC, trip_count DESC) = 1"""


def line(*, drop: int = 0, separator: str = ",", **changed: str) -> str:
    """A message line from the columns of ``trips``."""
    times = ("pickup_datetime", "dropoff_datetime")
    texts = [
        changed.get(name)
        or (
            f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f')"
            if name in times
            else f"CAST({name} AS VARCHAR)"
        )
        for name in LINE_FIELDS
    ]
    return f"concat_ws('{separator}', {', '.join(texts[: len(texts) - drop])})"


SECONDS = "%Y-%m-%d %H:%M:%S"
REJECT_LINES = f"""WITH {TRIPS}, flawed AS (
SELECT CASE event_id % 100
    WHEN 0 THEN '{",".join(CSV_HEADER)}'
    WHEN 1 THEN '   '
    WHEN 2 THEN {line(drop=1)}
    WHEN 3 THEN {line(airport_fee="''")}
    WHEN 4 THEN {line(passenger_count="'1.0'")}
    WHEN 5 THEN {line(passenger_count="''")}
    WHEN 6 THEN {line(fare_amount="'nan'")}
    WHEN 7 THEN {line(dropoff_datetime=f"strftime(dropoff_datetime, '{SECONDS}')")}
    WHEN 8 THEN {line(
        pickup_datetime="strftime(pickup_datetime, '%Y-%m-%dT%H:%M:%S.%f')",
        dropoff_datetime="strftime(dropoff_datetime, '%Y-%m-%dT%H:%M:%S.%f')",
    )}
    WHEN 9 THEN {line(
        vendor_id="'x'", pickup_datetime="'soon'", dropoff_datetime="'later'"
    )}
  END AS line, {FLAWS} AS reason, pickup_datetime AS record_time
FROM trips)
SELECT line, reason, record_time FROM flawed WHERE reason IS NOT NULL"""

HEADERS = ", ".join(
    f"{name} AS {header.lower()}"
    for name, header in zip(LINE_FIELDS, CSV_HEADER, strict=True)
)

PIPELINE = f"""WITH {TRIPS}, {FLAWED_TRIPS}, {fired(good="reason IS NULL")},
final AS (
  SELECT * FROM emitted
  QUALIFY row_number() OVER (PARTITION BY window_start ORDER BY slice DESC) = 1
)
SELECT table_name, CAST(row_count AS BIGINT) AS row_count, fare_total FROM (
  SELECT unnest(['taxi_trips', 'yellow_taxi_stream']) AS table_name, row_count, fare_total
  FROM (SELECT count(*) AS row_count, round(sum(fare_amount), 2) AS fare_total
        FROM flawed WHERE reason IS NULL)
  UNION ALL SELECT 'hourly_aggregates', sum(n), round(sum(total), 2) FROM final
  UNION ALL SELECT 'emissions', count(*), round(sum(total), 2) FROM emitted
  UNION ALL SELECT 'late_drops', sum(n), round(sum(total), 2) FROM lost
  UNION ALL SELECT 'rejects', count(*), CAST(0.0 AS DOUBLE) FROM flawed WHERE reason IS NOT NULL
)"""

EDGES = """WITH moments AS (
  SELECT event_id, make_date(2023 + event_id % 3, event_id % 12 + 1, 1) AS month, ts FROM events
), days AS (
  SELECT *, CAST(least(28 + event_id % 4, day(last_day(month))) AS INTEGER) AS d FROM moments
)
SELECT CASE WHEN event_id % 5 = 0 THEN month + to_days(d)
    ELSE month + to_days(d - 1) + to_hours(event_id % 24) + to_minutes(minute(ts))
      + to_seconds(second(ts)) END AS pickup_datetime,
  count(*) AS trip_count
FROM days GROUP BY 1"""

KINDS = {name: "DOUBLE" for name in CSV_HEADER[10:]} | {
    "VendorID": "INT", "tpep_pickup_datetime": "TIMESTAMP_NTZ", "tpep_dropoff_datetime": "TIMESTAMP_NTZ",
    "passenger_count": "INT", "trip_distance": "DOUBLE", "RatecodeID": "INT", "store_and_fwd_flag": "STRING",
    "PULocationID": "INT", "DOLocationID": "INT", "payment_type": "INT",
}
LOADED_DDL = " UNION ALL ".join(
    f"SELECT '{name.lower()}' AS column_name, '{kind}' AS column_type, count(*) AS value_count FROM events"
    for name, kind in KINDS.items()
)
CREATED = f"""WITH {TRIPS}
SELECT unnest(['taxi_trips', 'yellow_taxi_stream']) AS table_name, count(*) AS row_count FROM trips
UNION ALL
SELECT 'hourly_aggregates', count(DISTINCT date_trunc('hour', pickup_datetime)) FROM trips"""

FARE_RANGE = f"""WITH {TRIPS}
SELECT CAST(hour(pickup_datetime) AS INTEGER) AS "hour",
  CAST(date_trunc('hour', pickup_datetime) AS TIMESTAMP) AS window_start,
  CAST(date_trunc('hour', pickup_datetime) AS TIMESTAMP) + INTERVAL 1 HOUR AS window_end,
  max(fare_amount) - min(fare_amount) AS fare_range,
  max(dropoff_datetime) AS last_dropoff,
  count(*) FILTER (store_and_fwd_flag = 'Y') AS flagged_trips,
  CASE WHEN min(fare_amount) < 0 THEN 'refunds' END AS refunds
FROM trips GROUP BY 1, 2, 3"""

ATOMIC = f"""WITH {TRIPS}, {FLAWED_TRIPS},
span AS (SELECT min(ts) AS low, (max(ts) - min(ts)) / {SLICES} AS step FROM events),
cuts AS (
  SELECT [date_trunc('hour', low + step * part) + INTERVAL 5 MINUTE FOR part IN range(1, {SLICES})] AS bounds
  FROM span
),
placed AS (
  SELECT reason, len(list_filter(bounds, lambda b: ts >= b)) AS slice
  FROM flawed JOIN events USING (event_id), cuts
),
seen AS (
  SELECT stage, table_name, (table_name = 'rejects') = (reason IS NOT NULL) AS counted
  FROM placed
  JOIN (VALUES ('failed', 0), ('repeated', 1), ('finished', 2)) stages(stage, last) ON slice <= last,
  (SELECT unnest(['taxi_trips', 'yellow_taxi_stream', 'rejects']) AS table_name)
)
SELECT stage, table_name, count(*) AS row_count FROM seen WHERE counted GROUP BY stage, table_name"""

MERGED = f"""WITH {TRIPS}, {FLAWED_TRIPS}, {fired()}
SELECT CAST(hour(window_start) AS INTEGER) AS "hour",
  CAST(window_start AS TIMESTAMP) AS window_start,
  CAST(window_end AS TIMESTAMP) AS window_end,
  {six_digits('total / n')} AS average_fare, n AS trip_count
FROM emitted
QUALIFY row_number() OVER (PARTITION BY window_start ORDER BY slice DESC) = 1"""

HOURLY_LOOKUP = """WITH groups AS (
  SELECT date_trunc('hour', ts) AS window_start, hour(ts) AS h, strftime(ts, '%Y-%m') AS month, count(*) AS trips
  FROM events GROUP BY 1, 2, 3
)
SELECT 'hour ' || h AS wanted, count(*) AS row_count, CAST(sum(trips) AS BIGINT) AS trips,
  count(DISTINCT month) AS files_read
FROM groups WHERE h IN (0, 8, 17) GROUP BY h
UNION ALL
SELECT 'day', count(*), CAST(sum(trips) AS BIGINT),
  (SELECT count(DISTINCT h) FROM groups WHERE month = '2024-01')
FROM groups WHERE window_start >= TIMESTAMP '2024-01-12 06:00:00' AND window_start < TIMESTAMP '2024-01-13 06:00:00'"""

INDEXED_LOOKUP = f"""WITH {TRIPS}
SELECT pickup_datetime, dropoff_datetime, fare_amount, true AS few_files FROM trips
WHERE pickup_datetime BETWEEN TIMESTAMP '2024-01-12 06:00:00' AND TIMESTAMP '2024-01-12 12:00:00'"""

PROGRESS = f"""WITH {TRIPS}, {FLAWED_TRIPS}, {fired(good="reason IS NULL")},
reasons AS (SELECT unnest(['header', 'blank', 'arity', 'number', 'datetime']) AS reason)
SELECT query_name, counter, CAST(total AS BIGINT) AS total FROM (
  SELECT 'trips' AS query_name, 'lines' AS counter, count(*) AS total FROM flawed
  UNION ALL SELECT 'trips', reasons.reason, count(flawed.event_id)
    FROM reasons LEFT JOIN flawed ON flawed.reason = reasons.reason GROUP BY reasons.reason
  UNION ALL SELECT 'windows', kinds.kind, count(emitted.kind)
    FROM (SELECT unnest(['ontime', 'refire']) AS kind) kinds LEFT JOIN emitted ON emitted.kind = kinds.kind
    GROUP BY kinds.kind
  UNION ALL SELECT 'windows', 'dropped_trips', coalesce(sum(n), 0) FROM lost
)"""

# A window is held until five minutes after its end are over.
WINDOWS_HELD = f"""WITH {TRIPS}, {FLAWED_TRIPS}, {fired()},
last AS (SELECT max(watermark) AS watermark FROM newest)
SELECT CAST(hour(window_start) AS INTEGER) AS "hour",
  CAST(window_start AS TIMESTAMP) AS window_start,
  CAST(window_end AS TIMESTAMP) AS window_end,
  {six_digits('avg(fare_amount)')} AS average_fare, count(*) AS trip_count,
  bool_or(window_end <= watermark) AS fired
FROM kept, last
WHERE watermark < window_start + INTERVAL 65 MINUTE
GROUP BY window_start, window_end"""

# The sum as one whole number of 2^-96, and then as a double from its last digits up.
HOURLY_EXACT = f"""WITH {TRIPS},
sums AS (
  SELECT date_trunc('hour', pickup_datetime) AS w, count(*) AS n,
    sum(CAST(fare_amount * pow(2, 96) AS HUGEINT)) AS total
  FROM trips GROUP BY 1
),
parts AS (SELECT *, abs(total) AS size, pow(2, 48)::HUGEINT AS unit FROM sums)
SELECT CAST(hour(w) AS INTEGER) AS "hour", CAST(w AS TIMESTAMP) AS window_start,
  CAST(w AS TIMESTAMP) + INTERVAL 1 HOUR AS window_end,
  CASE WHEN total < 0 THEN -1.0 ELSE 1.0 END::DOUBLE * (
    (size % unit)::DOUBLE * pow(2, -96) + ((size // unit) % unit)::DOUBLE * pow(2, -48)
    + (size // unit // unit)::DOUBLE
  ) / n AS average_fare,
  n AS trip_count
FROM parts"""

REFIRES = f"""WITH {TRIPS}, {FLAWED_TRIPS}, {fired(lateness=DELAY)},
counted AS (
  SELECT *, sum(fare_amount) OVER so_far AS total, count(*) OVER so_far AS n FROM kept
  WINDOW so_far AS (PARTITION BY window_start ORDER BY slice, moment, fare_amount ROWS UNBOUNDED PRECEDING)
)
SELECT CAST(hour(window_start) AS INTEGER) AS "hour",
  CAST(window_start AS TIMESTAMP) AS window_start,
  CAST(window_end AS TIMESTAMP) AS window_end,
  {six_digits('total / n')} AS average_fare, n AS trip_count, kind
FROM (
  SELECT kind, window_start, window_end, total, n FROM ontime
  UNION ALL SELECT 'refire', window_start, window_end, total, n FROM counted WHERE due
  UNION ALL SELECT kind, window_start, window_end, total, n FROM lost
)"""

ORACLE: dict[str, str] = {
    "parse_trips": f"WITH {TRIPS}, {FLAWED_TRIPS} SELECT {FIELDS}, {DURATION} "
    "FROM flawed WHERE reason IS NULL",
    "reject_reasons": f"WITH {TRIPS}, {FLAWED_TRIPS} SELECT reason, count(*) AS line_count "
    "FROM flawed WHERE reason IS NOT NULL GROUP BY reason",
    "reject_lines": REJECT_LINES,
    "trip_duration": f"""WITH {TRIPS}, both_ways AS (
  SELECT pickup_datetime, dropoff_datetime FROM trips
  UNION ALL SELECT dropoff_datetime, pickup_datetime FROM trips
) SELECT pickup_datetime, dropoff_datetime, {DURATION} FROM both_ways""",
    "pickup_hour": f"WITH {TRIPS} SELECT CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour, "
    "count(*) AS trip_count FROM trips GROUP BY 1",
    "pickup_millis": f"WITH {TRIPS} SELECT pickup_datetime, "
    "epoch_us(pickup_datetime) // 1000 AS pickup_millis FROM trips",
    "decode_vendor": name_counts("vendor_name", VENDOR),
    "decode_rate": name_counts("rate_code_name", RATE),
    "decode_payment": name_counts("payment_type_name", PAYMENT),
    "decoded_trips": DECODED,
    "hourly_fares_pickup": HOURLY_PICKUP,
    "hourly_fares_ingest": HOURLY_INGEST,
    "hourly_fares_exact": HOURLY_EXACT,
    "hourly_fares_stream": HOURLY_INGEST,
    "hourly_fares_late": late("10 SECOND"),
    "hourly_fares_delayed": late(DELAY),
    "hourly_fares_idle": late("10 SECOND"),
    "hourly_refires": REFIRES,
    "hourly_latest": LATEST,
    "publish_lines": f"WITH {TRIPS} SELECT {line()} AS line FROM trips",
    "publish_roundtrip": RAW,
    "publish_files": RAW,
    "overall_fare": f"WITH {TRIPS} SELECT {six_digits('avg(fare_amount)')} AS average_fare, "
    "count(*) AS trip_count FROM trips",
    "load_csv": f"WITH {TRIPS} SELECT {HEADERS} FROM trips",
    "load_csv_inferred": f"WITH {TRIPS} SELECT {HEADERS} FROM trips",
    "loaded_ddl": LOADED_DDL,
    "published_count": "SELECT count(*) // 2 AS lines_reported, count(*) // 2 AS lines_found, "
    "count(*) // 2 AS distinct_lines FROM events",
    "calendar_edges": EDGES,
    # The text shows times to the millisecond.
    "debug_text": f"WITH {TRIPS} SELECT vendor_id, passenger_count, "
    "CAST(date_trunc('milliseconds', pickup_datetime) AS TIMESTAMP) AS pickup_datetime, "
    "CAST(date_trunc('milliseconds', dropoff_datetime) AS TIMESTAMP) AS dropoff_datetime, "
    f"trip_distance, fare_amount, total_amount, date_sub('second', trips.pickup_datetime, trips.dropoff_datetime) "
    "AS trip_duration FROM trips",
    "sink_raw": RAW,
    "sink_decoded": DECODED,
    "sink_hourly": HOURLY_PICKUP,
    "sink_two_runs": RAW,
    "table_ids": "SELECT count(*) AS row_count, count(*) AS distinct_ids, count(*) AS write_times FROM events",
    "created_tables": CREATED,
    "applied_window_udf": HOURLY_PICKUP,
    "applied_window_late": late("10 SECOND"),
    "applied_window_stream": FARE_RANGE,
    "whole_pipeline": PIPELINE,
    "resumed_replay": RAW,
    "progress_counts": PROGRESS,
    "moved_windows": late("10 SECOND"),
    "windows_held": WINDOWS_HELD,
    "atomic_batches": ATOMIC,
    "dense_keys": "SELECT count(*) AS row_count, count(*) AS distinct_ids, CAST(1 AS BIGINT) AS first_id, "
    "count(*) AS last_id, CAST(4 AS BIGINT) AS batches FROM events",
    "merged_latest": MERGED,
    "hourly_lookup": HOURLY_LOOKUP,
    "indexed_lookup": INDEXED_LOOKUP,
}
