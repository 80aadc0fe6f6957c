"""Lines out to a topic, to message files, or to the console."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from meterline.sinks.tables import batch_path, run_of


def kafka_write_options(
    servers: str, topic: str, client: dict[str, str] | None = None
) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    options.update({f"kafka.{name}": value for name, value in (client or {}).items()})
    return options


def kafka_lines(lines: DataFrame, servers: str, topic: str, **options) -> None:
    """Publish ``value`` of every row, without a key. A failed task is retried whole."""
    settings = kafka_write_options(servers, topic, **options)
    lines.select("value").write.format("kafka").options(**settings).save()


def message_files(lines: DataFrame, path: str) -> None:
    """Append messages (``value``, ``timestamp``) to a folder a stream can read."""
    lines.select("value", "timestamp").write.mode("append").parquet(path)


def line_files(lines: DataFrame, path: str) -> None:
    """Append the bare lines to text files, the stand-in for a topic."""
    lines.select("value").write.mode("append").text(path)


def line_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for lines as text files; a batch written again replaces itself."""

    def write(lines: DataFrame, batch_id: int) -> None:
        lines.select("value").write.mode("overwrite").text(batch_path(path, run_of(lines), batch_id))

    return write


def console(frame: DataFrame, name: str, mode: str = "append") -> DataStreamWriter:
    """A named debug print of a stream; the caller starts it."""
    return (
        frame.writeStream.format("console")
        .option("truncate", False)
        .outputMode(mode)
        .queryName(name)
    )
