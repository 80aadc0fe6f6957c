from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from meterline.schemas import CSV_HEADER
from meterline.session import SETTINGS

HEADER = ",".join(CSV_HEADER)
# Made-up trips: a plain one, one over the full hour, and a refund with its charge.
SAMPLE = [
    "1,2025-01-01 00:12:05.000000,2025-01-01 00:31:20.000000,2,4.4,1,N,41,166,1,"
    "21.5,1.0,0.5,4.8,0.0,1.0,31.3,2.5,0.0",
    "2,2025-01-01 00:52:40.000000,2025-01-01 01:10:15.000000,1,3.05,1,N,13,87,2,"
    "17.0,1.0,0.5,0.0,0.0,1.0,22.0,2.5,0.0",
    "2,2025-01-01 00:07:30.000000,2025-01-01 00:13:02.000000,1,1.15,1,N,50,246,4,"
    "-9.3,-1.0,-0.5,0.0,0.0,-1.0,-14.3,-2.5,0.0",
    "2,2025-01-01 00:07:30.000000,2025-01-01 00:13:02.000000,1,1.15,1,N,50,246,4,"
    "9.3,1.0,0.5,0.0,0.0,1.0,14.3,2.5,0.0",
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """Make a frame of message lines."""

    def make(*texts):
        return spark.createDataFrame([(text,) for text in texts], "value STRING")

    return make


def trip_line(**changes: str) -> str:
    """The first sample line with some fields replaced."""
    fields = dict(zip(HEADER.split(","), SAMPLE[0].split(",")))
    fields.update(changes)
    return ",".join(fields.values())
