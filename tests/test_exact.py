"""Exact sums next to rational arithmetic, however the rows are dealt."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from meterline.functions.exact import exact_mean, exact_sums, exact_total
from meterline.operators.hourly import hourly_fares


def totals(frame):
    made = frame.groupBy("k").agg(exact_sums(F.col("x")).alias("s"))
    return {r["k"]: (r["total"], r["mean"]) for r in made.select("k", exact_total(F.col("s")).alias("total"), exact_mean(F.col("s")).alias("mean")).collect()}


def values():
    rng = random.Random(8)
    groups = {
        "fares": [round(rng.uniform(-60, 90), 2) for _ in range(3000)],
        "cancel": [1e15, 0.1, -1e15, 0.1, 2.0**-40] * 40,
        "negative": [-0.1] * 1000,
        "wide": [rng.uniform(-1, 1) * 2.0 ** rng.randrange(-40, 70) for _ in range(2000)],
        "zero": [0.0, -0.0, 5.5, -5.5],
        "one": [-1.5],
        "edge": [2.0**72 - 2.0**20, 1.0, -(2.0**71)],
    }
    return groups


def test_sums_are_those_of_rational_numbers(spark):
    groups = values()
    frame = spark.createDataFrame([(k, x) for k, xs in groups.items() for x in xs], "k string, x double").repartition(5)
    found = totals(frame)
    for name, xs in groups.items():
        exact = float(sum(map(Fraction, xs)))
        assert found[name][0] == pytest.approx(exact, rel=2**-52, abs=0), name
        assert found[name][1] == found[name][0] / len(xs)
    assert found["fares"][0] == math.fsum(groups["fares"]) and found["cancel"][0] == math.fsum(groups["cancel"])


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_the_same_bits_however_rows_are_dealt(spark, parts):
    rows = [(k, x) for k, xs in values().items() for x in xs]
    expected = totals(spark.createDataFrame(rows, "k string, x double").coalesce(1))
    random.Random(parts).shuffle(rows)
    assert totals(spark.createDataFrame(rows, "k string, x double").repartition(parts)) == expected


def test_values_that_lanes_do_not_hold(spark):
    rows = [("nan", math.nan), ("nan", 1.0), ("inf", math.inf), ("inf", 1.0), ("both", math.inf), ("both", -math.inf)]
    rows += [("huge", 1e300), ("huge", 1.0), ("tiny", 5e-324), ("tiny", 5e-324), ("mixed", 1e-200), ("mixed", 0.5)]
    rows += [("null", None), ("null", None), ("some", None), ("some", 2.5)]
    found = {k: total for k, (total, _) in totals(spark.createDataFrame(rows, "k string, x double")).items()}
    assert math.isnan(found["nan"]) and math.isnan(found["both"]) and found["inf"] == math.inf
    assert (found["huge"], found["tiny"], found["mixed"], found["null"], found["some"]) == (1e300, 1e-323, 0.5, None, 2.5)
    assert totals(spark.createDataFrame(rows, "k string, x double"))["some"][1] == 2.5


def test_hourly_means_of_any_dealing(spark):
    rng = random.Random(3)
    start = datetime(2025, 1, 1)
    rows = [(start + timedelta(minutes=rng.randrange(300)), rng.uniform(-9, 99)) for _ in range(4000)]
    frame = spark.createDataFrame(rows, "pickup_datetime timestamp_ntz, fare_amount double")

    def means(parts):
        return {tuple(r) for r in hourly_fares(frame.repartition(parts), "pickup_datetime", exact=True).collect()}

    assert means(1) == means(7) == means(200)
    by_hour = {}
    for moment, fare in rows:
        by_hour.setdefault(moment.hour, []).append(fare)
    assert {(r[0], r[3], r[4]) for r in means(3)} == {(h, math.fsum(f) / len(f), len(f)) for h, f in by_hour.items()}


def test_lanes_are_added_per_task(spark):
    frame = spark.range(10).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("x"))
    plan = frame.groupBy("k").agg(exact_sums(F.col("x")).alias("s"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Python" not in plan
