from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE, trip_line
from meterline import session
from meterline.operators.decode import decode
from meterline.operators.hourly import hourly_fares
from meterline.operators.parse import classify, parse_trips, rejects, trips
from meterline.plans.pipeline import Outputs
from meterline.schemas import DECODED, HOURLY, TRIP
from meterline.session import drop_scratch, scratch_dir
from meterline.sinks import jdbc
from meterline.sinks.tables import (
    by_day,
    create_tables,
    hourly_sink,
    read_table,
    refresh_table,
    trip_sink,
    write_batch,
)
from meterline.sinks.topic import kafka_write_options
from meterline.sources.jdbc import jdbc_read_options
from meterline.sources.kafka import kafka_options, values


@pytest.fixture
def sample(lines):
    next_day = trip_line(
        tpep_pickup_datetime="2025-01-02 00:00:00", tpep_dropoff_datetime="2025-01-02 00:00:09"
    )
    return parse_trips(lines(next_day, *SAMPLE))


def test_a_batch_written_again_replaces_itself(spark, sample, tmp_path):
    path = str(tmp_path / "taxi_trips")
    write = trip_sink(path, row_id=True, created_at=True)
    write(sample, 3)
    write(sample, 3)
    write(sample.limit(1), 4)
    frame = read_table(spark, path, TRIP)
    assert sorted(r["count"] for r in frame.groupBy("batch_id").count().collect()) == [1, 5]
    stored = spark.read.parquet(path)
    assert stored.filter("batch_id = 3").select("id").distinct().count() == 5
    assert stored.filter(F.col("created_at").isNull()).count() == 0


def test_batches_of_two_runs_stay_apart(spark, sample, tmp_path):
    path = str(tmp_path / "taxi_trips")
    for run in ("one", "two", "two"):
        write_batch(by_day(sample), path, 0, run)
    counts = read_table(spark, path, TRIP).groupBy("run_id", "batch_id").count().collect()
    assert sorted(tuple(r) for r in counts) == [("one", 0, 5), ("two", 0, 5)]


def test_shuffled_backfill_gets_a_file_per_day_and_rejects_few(spark, tmp_path):
    days = F.make_dt_interval((F.col("id") % 30).cast("int"))
    trips = parse_trips(spark.range(0, 3000, 1, 16).select("id", F.lit(SAMPLE[0]).alias("value")))
    trips = trips.withColumn("pickup_datetime", F.col("pickup_datetime") + days).drop("id")
    root = str(tmp_path)
    outputs = Outputs.below(root)
    outputs.raw(trips, 0)
    outputs.rejected(spark.range(0, 400, 1, 16).select(F.lit("x").alias("value")), 0)

    def files(name):
        return sum(f.endswith(".parquet") for _, _, found in os.walk(f"{root}/{name}") for f in found)

    assert files("taxi_trips") == 30 and files("rejects") == 1


def test_long_backfill_gets_a_file_per_month(spark, tmp_path):
    """The rows and columns of the layout by day, in a thirtieth of the files."""
    days = F.make_dt_interval((F.col("id") % 365).cast("int"))
    trips = parse_trips(spark.range(0, 1095, 1, 16).select("id", F.lit(SAMPLE[0]).alias("value")))
    trips = trips.withColumn("pickup_datetime", F.col("pickup_datetime") + days).drop("id")
    by_month = Outputs.below(f"{tmp_path}/month", months=True)
    by_month.raw(trips, 0)
    by_month.raw(trips.limit(0), 1)
    by_month.decoded(decode(trips), 0)
    trip_sink(f"{tmp_path}/day/taxi_trips")(trips, 0)
    for name in ("taxi_trips", "yellow_taxi_stream"):
        found = [(where, f) for where, _, fs in os.walk(f"{tmp_path}/month/{name}") for f in fs if f.endswith(".parquet")]
        assert len({where for where, _ in found if "pickup_month=" in where}) == 12
        assert len([where for where, _ in found if "batch_id=0" in where]) == 12
    laid, daily = (read_table(spark, f"{tmp_path}/{span}/taxi_trips", TRIP) for span in ("month", "day"))
    assert sorted(laid.columns) == sorted([*daily.columns, "pickup_month"])
    columns = [*TRIP.fieldNames(), "pickup_date"]
    assert sorted(laid.select(columns).collect()) == sorted(daily.select(columns).collect())
    assert laid.filter("pickup_date = DATE'2025-02-11'").count() == 3
    assert laid.filter("pickup_month <> trunc(pickup_date, 'month')").count() == 0


def test_layout_prunes_days(spark, sample, tmp_path):
    path = str(tmp_path / "taxi_trips")
    trip_sink(path)(sample, 0)
    assert sorted(os.listdir(f"{path}/run_id=direct/batch_id=0"))[-2:] == [
        "pickup_date=2025-01-01",
        "pickup_date=2025-01-02",
    ]
    day = read_table(spark, path, TRIP).filter("pickup_date = DATE'2025-01-02'")
    assert day.count() == 1
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_date" in plan


def test_rebalanced_backfill_cuts_a_hot_day(spark, tmp_path):
    """Days in any order, one of them a third of all rows: few files, hot day in several."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    rows = spark.range(0, 60_000, 1, 16).withColumn(
        "day", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20).cast("int")
    )
    later = F.make_dt_interval(F.col("day"), secs=(F.col("id") % 1000).cast("decimal(18,6)"))
    trips = parse_trips(rows.select("id", "day", F.lit(SAMPLE[0]).alias("value"))).withColumn(
        "pickup_datetime", F.col("pickup_datetime") + later
    ).withColumn("fare_amount", F.rand(3))
    path = str(tmp_path / "taxi_trips")
    spark.conf.set(size, "100k")
    try:
        trip_sink(path, rebalance=True)(trips.drop("id", "day"), 0)
    finally:
        spark.conf.unset(size)
    stored = read_table(spark, path, TRIP)
    assert stored.count() == 60_000
    days = {
        day: sum(name.endswith(".parquet") for name in os.listdir(f"{path}/run_id=direct/batch_id=0/{day}"))
        for day in os.listdir(f"{path}/run_id=direct/batch_id=0")
        if day.startswith("pickup_date=")
    }
    assert len(days) == 20
    assert days["pickup_date=2025-01-01"] > 1
    assert sum(days.values()) < 16 * 20


def test_decoded_and_hourly_read_back(spark, sample, tmp_path):
    decoded, hourly = str(tmp_path / "decoded"), str(tmp_path / "hourly")
    trip_sink(decoded)(decode(sample), 0)
    names = DECODED.fieldNames()
    assert sorted(read_table(spark, decoded, DECODED).select(names).collect()) == sorted(
        decode(sample).collect()
    )
    hourly_sink(hourly)(hourly_fares(sample, "pickup_datetime"), 0)
    back = read_table(spark, hourly, HOURLY)
    assert back.filter("trip_count = 4").first().window_start == datetime(2025, 1, 1)
    files = [f for f in os.listdir(f"{hourly}/run_id=direct/batch_id=0") if f.endswith(".parquet")]
    assert len(files) == 1


def test_catalog_tables(spark, sample, tmp_path):
    root = str(tmp_path)
    create_tables(spark, root)
    create_tables(spark, root)
    try:
        trip_sink(f"{root}/taxi_trips")(sample, 0)
        refresh_table(spark, "taxi_trips")
        assert spark.table("taxi_trips").count() == 5
        assert spark.table("hourly_aggregates").columns == [*HOURLY.fieldNames(), "written_at", "run_id", "batch_id"]
        assert spark.table("yellow_taxi_stream").columns[:19] == DECODED.fieldNames()
    finally:
        for name in ("taxi_trips", "yellow_taxi_stream", "hourly_aggregates"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_creating_tables_reports_failures(spark):
    with pytest.raises(Exception, match="SCHEMA_NOT_FOUND|not found|cannot be found"):
        create_tables(spark, "/tmp/nowhere", database="missing")


def test_flags_too_wide_for_the_database(lines):
    texts = [SAMPLE[0], "x", *(trip_line(store_and_fwd_flag=flag) for flag in ("YY", ""))]
    frame = jdbc.refuse_wide_flags(classify(lines(*texts)))
    assert sorted(r.store_and_fwd_flag for r in trips(frame).collect()) == ["", "N"]
    assert sorted(r.reason for r in rejects(frame).collect()) == ["arity", "flag_width"]


def test_database_writer_options():
    connection = {"user": "u", "password": "p"}
    raw = jdbc.write_options(jdbc.RAW, "jdbc:x", connection)
    assert raw == {
        "url": "jdbc:x",
        "dbtable": "taxi_trips",
        "batchsize": "100",
        "user": "u",
        "password": "p",
        "createTableColumnTypes": "store_and_fwd_flag VARCHAR(1)",
    }
    assert jdbc.write_options(jdbc.DECODED_TRIPS, "jdbc:x")["batchsize"] == "20"
    hourly = jdbc.write_options(jdbc.HOURLY_FARES, "jdbc:x", batch_rows=500)
    assert hourly == {"url": "jdbc:x", "dbtable": "hourly_aggregates", "batchsize": "500"}


def test_database_columns_in_insert_order(sample):
    decoded = jdbc.DECODED_TRIPS.select(decode(sample).withColumn("batch", F.lit(1)))
    assert decoded.columns == DECODED.fieldNames()
    hourly = jdbc.HOURLY_FARES.select(hourly_fares(sample, "pickup_datetime"))
    assert dict(hourly.dtypes)["trip_count"] == "int"


def test_database_ddl():
    assert jdbc.ddl(jdbc.HOURLY_FARES, created_at=True) == (
        "CREATE TABLE IF NOT EXISTS hourly_aggregates (id SERIAL PRIMARY KEY, hour INTEGER, "
        "window_start TIMESTAMP, window_end TIMESTAMP, average_fare DOUBLE PRECISION, "
        "trip_count INTEGER, created_at TIMESTAMP DEFAULT CURRENT_TIMESTAMP)"
    )
    text = jdbc.ddl(jdbc.DECODED_TRIPS)
    assert "vendor_name VARCHAR(50), pickup_datetime TIMESTAMP" in text
    assert "store_and_fwd_flag VARCHAR(1)" in text
    assert "trip_duration BIGINT" in jdbc.ddl(jdbc.RAW)


def test_database_indexes():
    assert jdbc.index_ddl(jdbc.RAW) == [
        "CREATE INDEX IF NOT EXISTS idx_taxi_trips_pickup_datetime ON taxi_trips (pickup_datetime)"
    ]
    assert jdbc.index_ddl(jdbc.HOURLY_FARES)[1].endswith("(window_start, window_end)")
    assert jdbc.index_ddl(jdbc.DECODED_TRIPS) == []


def test_database_reader_options():
    assert jdbc_read_options("jdbc:x", "t") == {
        "url": "jdbc:x",
        "dbtable": "t",
        "fetchsize": "10000",
        "preferTimestampNTZ": "true",
    }
    split = jdbc_read_options("jdbc:x", "t", "id", 0, 100, 8, 30, {"user": "u"})
    assert split["partitionColumn"] == "id"
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("0", "100", "8")
    with pytest.raises(ValueError):
        jdbc_read_options("jdbc:x", "t", "id")


def test_topic_options():
    stream = kafka_options(
        "broker:1", "topic", rows_per_batch=30, min_partitions=64, client={"reconnect.backoff.ms": "1000"}
    )
    assert stream == {
        "kafka.bootstrap.servers": "broker:1",
        "subscribe": "topic",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "30",
        "minPartitions": "64",
        "kafka.reconnect.backoff.ms": "1000",
    }
    bounded = kafka_options("broker:1", "topic", rows_per_batch=30, bounded=True)
    assert bounded["endingOffsets"] == "latest"
    assert "maxOffsetsPerTrigger" not in bounded
    assert kafka_write_options("broker:1", "topic", {"acks": "all"}) == {
        "kafka.bootstrap.servers": "broker:1",
        "topic": "topic",
        "kafka.acks": "all",
    }


def test_records_become_text(spark):
    records = spark.sql("SELECT CAST('k' AS BINARY) key, CAST('a,b' AS BINARY) value, now() timestamp")
    frame = values(records)
    assert frame.columns == ["value", "timestamp"]
    assert frame.first().value == "a,b"


class Session:
    """Just what ``scratch_dir`` asks a session for."""

    def __init__(self, master, shared):
        self.sparkContext = self
        self.master = master
        self.conf = {"spark.checkpoint.dir": shared} if shared else {}


def test_scratch_is_below_the_shared_folder():
    cluster = Session("spark://host", "hdfs://shared/")
    one, two = scratch_dir(cluster, "x"), scratch_dir(cluster, "x")
    assert one.startswith("hdfs://shared/meterline-x-")
    assert one != two


def test_scratch_is_local_only_for_a_local_master():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session("spark://host", None), "x")
    assert scratch_dir(Session("local[8]", None), "x").startswith("/")


def test_scratch_is_dropped_on_request(spark, monkeypatch):
    monkeypatch.setattr(session, "_scratch", [])
    path = scratch_dir(spark, "x")
    spark.range(3).write.parquet(path)
    assert drop_scratch(spark) == 1 and not os.path.exists(path)
    assert drop_scratch(spark) == 0
