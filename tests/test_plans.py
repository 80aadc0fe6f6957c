"""The physical plans the operators are meant to have."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from catalog.trips import event_lines, events, slices
from meterline.operators.decode import decode
from meterline.operators.hourly import hourly_fares, latest
from meterline.operators.parse import classify, parse_trips, reject_counts
from meterline.schemas import HOURLY
from meterline.sources.files import message_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def messages(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("messages") / "m")
    event_lines(events(spark, SF)).write.parquet(path)
    return message_table(spark, path)


@pytest.fixture
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def method_sizes(spark, frame):
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    text = debug.codegenString(frame._jdf.queryExecution().executedPlan())
    return [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text)]


def test_parsing_is_one_generated_stage_the_jvm_compiles(spark, messages, static_plans):
    for frame in (
        classify(messages),
        parse_trips(messages),
        decode(parse_trips(messages)),
        hourly_fares(parse_trips(messages)),
        reject_counts(classify(messages)),
    ):
        sizes = method_sizes(spark, frame)
        assert sizes and max(sizes) < 8000
    text = plan(parse_trips(messages))
    assert len(set(re.findall(r"\*\((\d+)\)", text))) == 1
    assert "Python" not in text and "Exchange" not in text


def test_each_line_is_split_once(messages, static_plans):
    for frame in (parse_trips(messages), hourly_fares(parse_trips(messages))):
        assert plan(frame).count("EndsWith(value") == 1


def test_hourly_shuffles_partial_totals_only(messages, static_plans):
    text = plan(hourly_fares(parse_trips(messages)))
    assert text.count("Exchange") == 1
    assert "partial_avg(fare_amount" in text
    # Only the line and its record time are read.
    assert "ReadSchema: struct<value:string,timestamp:timestamp>" in text
    assert "ReadSchema: struct<value:string>" in plan(
        hourly_fares(parse_trips(messages), "pickup_datetime")
    )


def test_latest_shrinks_the_log_before_the_shuffle(spark, static_plans):
    log = spark.createDataFrame([], HOURLY).withColumn("batch_id", F.lit(1))
    text = plan(latest(log))
    assert text.count("Exchange") == 1
    assert "partial_max(" in text


def test_slices_reach_the_scan(spark, static_plans):
    source = events(spark, SF)
    low, high = source.agg(F.min("ts"), F.max("ts")).first()
    middle = low + (high - low) / 2
    parts = list(slices(source, [middle], F.col("ts")))
    assert sum(part.count() for part in parts) == source.count()
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts" in plan(parts[0])
