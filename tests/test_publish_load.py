from __future__ import annotations

import csv
import io
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import HEADER, SAMPLE
from meterline.operators.load import describe_ddl, load_trips
from meterline.operators.parse import parse_trips
from meterline.operators.publish import publish_lines
from meterline.schemas import CSV_TRIP, LINE_FIELDS
from meterline.sinks.tables import replace_table
from meterline.operators.publish import first_rows
from meterline.sources.files import line_file


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "trips.csv"
    path.write_bytes("\r\n".join([HEADER, *SAMPLE, ""]).encode())
    return str(path)


def test_inferred_and_declared_load_agree(spark, csv_file):
    inferred = load_trips(spark, csv_file)
    declared = load_trips(spark, csv_file, CSV_TRIP)
    assert inferred.schema == declared.schema == CSV_TRIP
    assert inferred.collect() == declared.collect()
    assert inferred.count() == 4
    assert "tpep_pickup_datetime TIMESTAMP_NTZ" in describe_ddl(inferred)


def test_declared_load_refuses_a_value_that_does_not_fit(spark, tmp_path):
    (tmp_path / "bad.csv").write_text(HEADER + "\n" + SAMPLE[0].replace("2,4.4", "2.0,4.4"))
    with pytest.raises(Exception, match="MALFORMED|2.0"):
        load_trips(spark, str(tmp_path / "bad.csv"), CSV_TRIP).collect()


def test_line_file_drops_carriage_returns_and_keeps_the_header(spark, csv_file):
    values = [row.value for row in line_file(spark, csv_file).collect()]
    assert values == [HEADER, *SAMPLE]
    assert parse_trips(line_file(spark, csv_file)).count() == 4


@pytest.mark.parametrize("rows", [0, 1, 499, 500, 501, 1500, 2000, 5000])
def test_a_cap_keeps_exactly_so_many_rows_in_several_tasks(spark, rows):
    table = spark.range(0, 2000, 1, 4)
    capped = first_rows(table, rows)
    kept = [row.id for row in capped.collect()]
    assert len(kept) == len(set(kept)) == min(rows, 2000)
    assert "SinglePartition" not in capped._jdf.queryExecution().toString()


def test_replace_table(spark, csv_file, tmp_path):
    target = str(tmp_path / "table")
    frame = load_trips(spark, csv_file, CSV_TRIP)
    replace_table(frame.unionByName(frame), target)
    replace_table(frame, target)
    assert spark.read.parquet(target).count() == 4


def test_lines_match_a_csv_writer(spark):
    """Text of each row as Python's csv module writes it (whole or mixed fractions aside)."""
    rows = [
        (1, datetime(2025, 1, 1, 0, 0, 5), 1.0, "N", None),
        (2, datetime(2025, 1, 1, 0, 0, 5, 120), -0.25, 'a "b", c', 12345678.5),
        (None, datetime(2025, 12, 31, 23, 59, 59, 999999), 0.0005, " x ", 1e-4),
        (3, None, 9999999.0, "", 123456789012345.0),
        (4, datetime(1999, 1, 1), 0.1 + 0.2, "line\nbreak", 0.00012345678901234567),
    ]
    frame = spark.createDataFrame(
        rows, "id INT, at TIMESTAMP_NTZ, fare DOUBLE, flag STRING, other DOUBLE"
    )
    found = [row.value for row in publish_lines(frame).collect()]
    expected = []
    for row in rows:
        text = io.StringIO()
        csv.writer(text, lineterminator="").writerow(row)
        expected.append(text.getvalue())
    # Python writes small doubles as 0.0001, 1e-05; both engines read either form.
    assert found == expected


def test_one_form_of_time_per_line(spark):
    whole, part = datetime(2025, 1, 1), datetime(2025, 1, 1, 0, 0, 0, 5)
    frame = spark.createDataFrame(
        [(whole, whole), (whole, part)], "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ"
    )
    assert [row.value for row in publish_lines(frame).collect()] == [
        "2025-01-01 00:00:00,2025-01-01 00:00:00",
        "2025-01-01 00:00:00.000000,2025-01-01 00:00:00.000005",
    ]
    always = publish_lines(frame, always_fraction=True).first().value
    assert always == "2025-01-01 00:00:00.000000,2025-01-01 00:00:00.000000"


def test_zoned_times_are_written_like_zoneless_ones(spark):
    frame = spark.createDataFrame(
        [(datetime(2025, 1, 1, 0, 0, 0, 5), datetime(2025, 1, 1))], "a TIMESTAMP, b TIMESTAMP_NTZ"
    )
    expected = "2025-01-01 00:00:00.000005,2025-01-01 00:00:00.000000"
    assert publish_lines(frame).first().value == expected


def test_round_trip_of_random_trips(spark):
    rng = random.Random(11)

    def amount():
        return rng.choice([rng.uniform(-1e3, 1e3), rng.uniform(0, 1e-3), 10 ** rng.uniform(6, 17)])

    rows = []
    for _ in range(500):
        start = datetime(2025, 1, 1) + timedelta(
            seconds=rng.randrange(10**7), microseconds=rng.choice([0, 0, rng.randrange(10**6)])
        )
        end = start + timedelta(seconds=rng.randrange(-50, 5000))
        end = end.replace(microsecond=rng.choice([0, rng.randrange(10**6)]))
        rows.append(
            (rng.randrange(8), start, end, 1, amount(), 1, rng.choice(["N", "Y", ""]), 5, 6, 2)
            + tuple(amount() for _ in range(9))
        )
    table = spark.createDataFrame(rows, LINE_FIELDS)
    back = parse_trips(publish_lines(table)).drop("trip_duration")
    assert sorted(back.collect()) == sorted(table.collect())


def test_rows_with_missing_numbers_do_not_come_back(spark):
    trip = (1, datetime(2025, 1, 1), datetime(2025, 1, 1), 1, 1.0, 1, None, 5, 6, 2) + (1.0,) * 9
    rows = [trip, (1, *trip[1:3], None, *trip[4:])]
    back = parse_trips(publish_lines(spark.createDataFrame(rows, LINE_FIELDS))).collect()
    assert len(back) == 1
    assert back[0].store_and_fwd_flag == ""


def test_cap_and_count(spark):
    table = spark.range(100).select(F.col("id").cast("double").alias("fare"))
    seen = Observation()
    lines = publish_lines(table, rows=30, published=seen)
    assert len(lines.collect()) == 30
    assert seen.get == {"lines": 30}
    assert publish_lines(table).count() == 100
