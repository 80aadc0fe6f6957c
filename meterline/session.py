"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
UTC_NAMES = {"UTC", "Etc/UTC", "UCT", "Etc/UCT", "GMT", "Etc/GMT", "Universal", "Zulu", "Z", "+00:00"}

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
}


def ship_by_value(module: str) -> None:
    """Send the functions of a module to the executors with their code.

    They then run where the package is not installed.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])


def build_session(name: str = "meterline", **settings: str) -> SparkSession:
    """A session with the settings above; ``settings`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Refuse sessions whose zone would shift zone-less trip times.

    Only the operators that put a trip time on Spark's zoned clock need this
    (watermarks accept no TIMESTAMP_NTZ); parsing and decoding are zone-free.
    """
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"set spark.sql.session.timeZone to UTC (it is {zone})")


#: Scratch folders of this process that have not been dropped.
_scratch: list[str] = []


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    A machine-local folder is used only by a local master without the setting. Frames
    that operators return read from such folders: ``drop_scratch`` when they are done.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        shared = tempfile.mkdtemp(prefix="meterline-")
    path = f"{shared.rstrip('/')}/meterline-{purpose}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this process made so far; gives their number."""
    dropped = 0
    while _scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        dropped += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return dropped


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, wherever Spark reads from."""
    system, place = _file_system(spark, path)
    return system.exists(place)


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """The paths a pattern with ``*`` stands for."""
    system, place = _file_system(spark, pattern)
    return [status.getPath().toString() for status in system.globStatus(place) or ()]


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder and all below it."""
    system, place = _file_system(spark, path)
    return system.delete(place, True)


@contextmanager
def stream_settings(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Settings in force while a query starts; Spark copies them at ``start()``."""
    wanted = {key.replace("__", "."): value for key, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
