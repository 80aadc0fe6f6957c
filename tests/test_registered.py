"""Every registered query next to its SQL, value by value, on the smallest tables."""

from __future__ import annotations

import os
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from catalog.oracle import ORACLE
from catalog.queries import QUERIES, tardy_slices
from catalog.trips import event_lines
from check import canonical, tables
from meterline import session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return tables(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    ours = canonical(queries()[name](spark, SF).toPandas())
    theirs = canonical(database.execute(oracle_sql()[name]).df())
    pd.testing.assert_frame_equal(ours, theirs, check_exact=True)
    assert len(ours)


@pytest.fixture
def long_span(spark, tmp_path):
    """A row every four hours for 300 days, in one file in time order."""
    ids = spark.range(0, 1800, 1, 1).withColumnRenamed("id", "event_id")
    start = F.lit(datetime(2024, 1, 1, 0, 10)).cast("timestamp_ntz")
    ids.select(
        "event_id",
        (start + F.make_dt_interval(hours=(4 * F.col("event_id")).cast("int"))).alias("ts"),
        (F.col("event_id") % 1500).alias("user_id"),
        F.when(F.col("event_id") % 7 == 0, "error").otherwise("view").alias("event_type"),
        (F.col("event_id") % 97 + 0.25).alias("value"),
        F.lit("{}").alias("props"),
    ).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_pipeline_over_many_days_writes_few_files(spark, database, long_span):
    ours = canonical(queries()["whole_pipeline"](spark, long_span).toPandas())
    database.execute(f"CREATE SCHEMA long; CREATE VIEW long.events AS FROM '{long_span}/events.parquet/*.parquet'")
    database.execute("USE long")
    try:
        theirs = canonical(database.execute(oracle_sql()["whole_pipeline"]).df())
    finally:
        database.execute("USE main")
    pd.testing.assert_frame_equal(ours, theirs, check_exact=True)
    (root,) = session._scratch[-1:]
    for name in ("taxi_trips", "yellow_taxi_stream"):
        files = [f for _, _, found in os.walk(f"{root}/{name}") for f in found if f.endswith(".parquet")]
        assert 10 <= len(files) <= 30


def test_a_slice_of_a_file_in_time_order_is_dealt_over_the_cores(spark, long_span):
    for lines in tardy_slices(spark, long_span, event_lines):
        counts = [row["count"] for row in lines.groupBy(F.spark_partition_id()).count().collect()]
        assert len(counts) == spark.sparkContext.defaultParallelism
        assert max(counts) <= 2 * min(counts) + 4


def test_entry_returns_rows(spark):
    assert entry(spark).count() > 0
