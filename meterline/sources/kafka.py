"""A topic of trip lines as a stream or as a bounded backfill.

Needs Spark's Kafka connector on the class path. Servers, topic and any client
setting come from the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


#: Bound of a micro-batch, so that the first one is not the whole backlog.
ROWS_PER_BATCH = 20_000_000


def kafka_options(
    servers: str,
    topic: str,
    rows_per_batch: int | None = ROWS_PER_BATCH,
    min_partitions: int | None = None,
    bounded: bool = False,
    client: dict[str, str] | None = None,
) -> dict[str, str]:
    """Reader options: from the earliest offset on; ``client`` are plain client settings."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if bounded:
        options["endingOffsets"] = "latest"
    elif rows_per_batch:
        options["maxOffsetsPerTrigger"] = str(rows_per_batch)
    if min_partitions:
        # More tasks than topic partitions: a one-partition topic still spreads.
        options["minPartitions"] = str(min_partitions)
    options.update({f"kafka.{name}": value for name, value in (client or {}).items()})
    return options


def values(records: DataFrame) -> DataFrame:
    """Only the value as text and the record time; key and headers are dropped."""
    return records.selectExpr("CAST(value AS STRING) AS value", "timestamp")


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    settings = kafka_options(servers, topic, **options)
    return values(spark.readStream.format("kafka").options(**settings).load())


def kafka_backfill(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    settings = kafka_options(servers, topic, bounded=True, **options)
    return values(spark.read.format("kafka").options(**settings).load())
